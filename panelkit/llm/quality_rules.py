"""Quality rules: counts of words, symbols and repeats, and a hashed n-gram likelihood ratio."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import WORD, table

#: Hash buckets of the two multinomials; a power of two.
BUCKETS = 1 << 18
#: Trusted documents that the target is counted from, at most: those with the smallest hashes.
TRUSTED_ROWS = 20_000
#: Added to a bucket's count and to the count expected there from the raw corpus.
SMOOTHING = 10.0
#: A document is kept if its mean log ratio per n-gram is at least this.
THRESHOLD = -0.12
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MOST_REPEATED = 50


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often `use` names it."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def symbol_count(text: Column) -> Column:
    return F.coalesce(F.length(text) - F.length(F.translate(text, SYMBOLS, "")), F.lit(0))


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(WORD))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text.

    Where the hashes of all windows differ, as in most texts, no window is repeated; the others are
    sorted as they are written.
    """

    def positions(windows: Column) -> Column:
        def twice(sorted_: Column) -> Column:
            return F.filter(sorted_, lambda x, k: (
                (k > 0) & (F.get(sorted_, k - 1)["w"] == x["w"])
            ) | F.coalesce(F.get(sorted_, k + 1)["w"] == x["w"], F.lit(False)))

        placed = F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
        covered = F.transform(
            let(F.sort_array(placed), twice),
            lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2),
        )
        return F.size(F.array_distinct(F.flatten(covered)))

    def windows(of: Callable[..., Column]) -> Column:
        starts = F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0)))
        return F.transform(starts, lambda w, i: of(w, F.get(words, i + 1), F.get(words, i + 2)))

    return let(windows(F.xxhash64), lambda x: F.when(
        F.size(F.array_distinct(x)) < F.size(x),
        positions(windows(lambda *three: F.concat_ws(" ", *three))),
    ).otherwise(F.lit(0)))


def hashed_ngrams(words: Column) -> Column:
    """Buckets of all words and all pairs of neighbouring words."""
    def bucket(h: Column) -> Column:
        return h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")

    single = F.transform(words, lambda w: bucket(F.xxhash64(w)))
    pairs = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda w, i: bucket(F.xxhash64(w, F.get(words, i + 1))),
    )
    return F.concat(single, pairs)


def trusted_ids(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """doc_ids labelled as good, `rows` at most: those whose ids have the smallest hashes."""
    good = labels.filter("quality = 1 and doc_id is not null").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def log_ratios(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row with `ratios`: log p(bucket | trusted) / p(bucket | raw) of every bucket, smoothed.

    The raw multinomial counts the n-grams of all `docs`, the target those of documents in
    `trusted` (doc_id; a bounded table, broadcast). Counts are summed per bucket in every task
    before they are shuffled, so a task sends at most BUCKETS rows whatever it reads. With no
    trusted document every ratio is 0.
    """
    marked = docs.select("doc_id", "text").join(
        F.broadcast(trusted.select("doc_id", F.lit(1).alias("good"))), "doc_id", "left"
    )
    counts = (
        marked.select("good", words_of(F.col("text")).alias("words"))
        .select("good", F.explode(hashed_ngrams(F.col("words"))).alias("bucket"))
        .groupBy("bucket").agg(F.count("*").alias("raw"), F.count("good").alias("target"))
    )
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    filled = every.join(counts, "bucket", "left").select(
        "bucket", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("raw", "target"))
    )
    row = filled.agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target"),
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("counts"),
    )

    def ratio(c: Column) -> Column:
        expected = c["raw"] * F.col("target") / F.col("raw")
        return F.log((c["target"] + SMOOTHING) / (expected + SMOOTHING))

    nothing = F.array_repeat(F.lit(0.0), BUCKETS)
    return row.select(F.when(F.col("target") > 0, F.transform("counts", ratio)).otherwise(nothing).alias("ratios"))


def judged(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept.

    score is the mean log likelihood ratio per n-gram between trusted documents and all documents:
    0 for a text without words. A document is kept if it does not fail the base rules and its score
    reaches THRESHOLD; every document is judged by the same two rules, no row is dropped here.

    Null texts count as empty (and fail the base rules); null ids are never trusted; repeated rows
    are judged alike; columns of `docs` with the names of results are replaced. Texts are read
    twice and never shuffled: the ratios are one bounded array that every task receives.
    """
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
           "score", "kept"]
    old = [c for c in docs.columns if c not in new]
    text = F.col("row.text")
    ratios = log_ratios(docs, trusted).scalar()
    counted = docs.select(F.struct(*old).alias("row")).select(
        "row", words_of(text).alias("words"),
        F.coalesce(F.length(F.translate(text, BLANKS, "")), F.lit(0)).cast("long").alias("word_chars"),
        symbol_count(text).cast("long").alias("n_symbols"),
        repeated_lines(text).cast("long").alias("n_dup_lines"),
    ).select(
        "row", F.size("words").cast("long").alias("n_words"), *new[1:4], repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        hashed_ngrams(F.col("words")).alias("grams"),
    ).select("row", *new[:5], F.explode(F.array("grams")).alias("grams"))
    # Above the unfolded column the optimizer puts the subquery's value into the sum: no row holds it.
    total = F.aggregate("grams", F.lit(0.0), lambda s, h: s + F.get("ratios", h))
    scored = counted.select("*", ratios.alias("ratios")).select(
        "row", *new[:5],
        F.coalesce(total / (2 * F.col("n_words") - 1), F.lit(0.0)).alias("score"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    return (
        scored.withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= THRESHOLD))
        .select("row.*", *new)
    )


def kept_documents(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns.

    The verdict is unfolded from an array before it is filtered by: a plain filter would be pushed
    below the columns it rests on, and the words of a text be found again for each of them.
    """
    named = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text")
    verdicts = judged(named, trusted).select("_row", F.explode(F.array("kept")).alias("_stays"))
    return verdicts.filter("_stays").select("_row.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = trusted_ids(table(spark, sf_dir, "labels"))
    return judged(docs, trusted).drop("text")


QUERIES = {"op2_quality_rules": op2_quality_rules}
#: Spark's 64-bit hash has no counterpart in SQL: the tests compare with a brute-force version.
ORACLES: dict[str, str] = {}
