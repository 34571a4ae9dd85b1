"""Mixing sources to target weights: weighted sampling without replacement by exponential keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.functions.ranking import value_codes
from panelkit.llm.common import table, word_count
from panelkit.storage import stage

#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: No source and no document is taken more often than this.
MOST_EPOCHS = 3
#: Ranges of keys that each source is cut into, so that no task sorts a whole source.
BUCKETS = 4096
#: Characters that lower a document's quality weight.
SYMBOLS = "#*$%&|<>!"


def quality_weight(text: Column, size: Column) -> Column:
    """0.25 to 1: falls with the symbols per word. A null or empty text weighs 1."""
    symbols = F.coalesce(F.length(text) - F.length(F.translate(text, SYMBOLS, "")), F.lit(0))
    return F.greatest(F.lit(0.25), 1.0 - symbols / F.greatest(size, F.lit(1)))


def exponential_key(doc_id: Column, weight: Column) -> Column:
    """-ln(u) / weight with u in (0, 1) from the id's MD5: the smallest keys are drawn first."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 1.0) / float(2**52 + 2)
    return -F.log(u) / weight


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """`sizes` (source, source_size), one row per source, with `target` added.

    Weights repeat over the sources in code point order, null last; the targets sum to the sum of
    all sizes. A target above three times its source stops there and the excess is shared anew by
    weight, until none is above. Only sums reach the driver, once per round of sharing.
    """
    sizes = stage(sizes, "source_sizes")
    codes = value_codes(sizes, ["source"]).select(F.col("value").alias("_value"), "code")
    known = codes.count()
    place = F.coalesce(F.col("code"), F.lit(known))
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    weighed = stage(
        sizes.join(codes, F.col("source") == F.col("_value"), "left")
        .select("source", "source_size", weight.cast("long").alias("_weight")),
        "source_weights",
    )
    most = F.col("source_size") * MOST_EPOCHS
    shared, free = weighed.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("_weight"), F.lit(1))
    ).first()
    total, all_free, stopped = shared, free, -1
    while True:
        share = F.col("_weight") * F.lit(shared) / F.lit(free).cast("double")
        above = share > most
        n, held, weights_held = weighed.filter(above).agg(
            F.count("*"), F.coalesce(F.sum(most), F.lit(0)), F.coalesce(F.sum("_weight"), F.lit(0))
        ).first()
        if n == stopped or n == 0:
            break
        stopped, shared, free = n, total - held, all_free - weights_held
    return weighed.select(
        "source", "source_size", F.when(above, most.cast("double")).otherwise(share).alias("target")
    )


def mix(docs: DataFrame, size: str | None = None, weight: str | None = None) -> DataFrame:
    """Every row of `docs` with size, source_size, target and taken (words, repeats counted).

    `docs` has doc_id and source, and either text or columns that already hold the `size` in words
    and the quality `weight`. Whole epochs of a source come first: each document is taken
    floor(target / source_size) times. What remains of the target is filled by weighted sampling
    without replacement: documents in order of their keys, as long as at least half of the next one
    fits, so a source misses its target by half a document at most.

    Sources are cut into ranges of keys: sizes are summed per range first, and rows are only sorted
    inside their range, after the sizes of the ranges before are known. A hot source is thus
    spread over thousands of groups.

    Null or empty texts have size 0 and are never taken; null sources form one source; null ids
    share one key; equal rows have equal keys and count one by one; an empty table gives no rows.
    Columns of `docs` named like the four results are replaced.
    """
    new = ("size", "source_size", "target", "taken")
    kept = [c for c in docs.columns if c not in new]
    words = F.col(size) if size else word_count(F.col("text"))
    start = docs.select(
        F.struct(*kept).alias("row"), words.cast("long").alias("size"),
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("group"),
        (F.col(weight) if weight else quality_weight(F.col("text"), words)).alias("weight"),
    )
    keyed = start.withColumn("key", exponential_key(F.col("row.doc_id"), F.col("weight")))
    near_one = F.floor((1.0 - F.exp(F.col("key") / -2.0)) * BUCKETS).cast("int")
    keyed = keyed.withColumn("bucket", F.least(near_one, F.lit(BUCKETS - 1))).drop("weight")
    ranges = stage(keyed.groupBy("group", "bucket").agg(F.sum("size").alias("words")), "key_ranges")
    name = F.when(F.col("group") != "", F.substring("group", 2, 1 << 30))
    targets = source_targets(
        ranges.groupBy("group").agg(F.sum("words").alias("source_size"))
        .select(name.alias("source"), "source_size")
    ).select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("group"),
        "source_size", "target",
    )
    before = W.partitionBy("group").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    placed = (
        ranges.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .join(targets, "group")
        .select("group", "bucket", "before", "source_size", "target")
    )
    inside = W.partitionBy("group", "bucket").orderBy("key", "row.doc_id", "size", "tie")
    reach = F.col("before") + F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    epochs = F.coalesce(epochs, F.lit(0))
    rest = F.col("target") - epochs * F.col("source_size")
    once_more = (reach - F.col("size") / 2.0 <= rest).cast("long")
    return (
        keyed.withColumn("tie", F.xxhash64("row"))
        .join(placed, ["group", "bucket"])
        .withColumn("taken", F.col("size") * (epochs + once_more))
        .select("row.*", *new)
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: the columns of `docs`, each row repeated as often as it is taken."""
    kept = docs.columns
    named = docs.select(
        F.struct(*kept).alias("row"), "doc_id", "source",
        word_count(F.col("text")).alias("words"),
    ).withColumn("weight", quality_weight(F.col("row.text"), F.col("words")))
    times = (F.col("taken") / F.col("size")).cast("int")
    return (
        mix(named, size="words", weight="weight")
        .filter(F.col("taken") > 0)
        .select("row", F.explode(F.sequence(F.lit(1), times)))
        .select("row.*")
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    words = word_count(F.col("text"))
    thin = docs.select(
        "doc_id", "source", words.alias("words"),
        quality_weight(F.col("text"), words).alias("weight"),
    )
    return mix(stage(thin, "document_sizes"), size="words", weight="weight").select(
        "doc_id", "size", "source_size", "target", "taken"
    )


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce(length(text) - length(translate(text, '#*$%&|<>!', '')), 0) AS symbols
  FROM documents
), keyed AS (
  SELECT doc_id, source, size,
         -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 1.0::DOUBLE) / 4503599627370498.0::DOUBLE)
           / greatest(0.25::DOUBLE, 1.0::DOUBLE - symbols / greatest(size, 1)) AS key
  FROM sized
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM keyed GROUP BY source
), ordered AS (
  SELECT *, coalesce(sum(3 * source_size) OVER w, 0)::BIGINT AS held,
         coalesce(sum(weight) OVER w, 0)::BIGINT AS weight_held,
         sum(source_size) OVER ()::BIGINT AS total, sum(weight) OVER ()::BIGINT AS weights
  FROM sources
  WINDOW w AS (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT total - held AS shared, weights - weight_held AS free FROM ordered
  WHERE 3.0 * source_size * (weights - weight_held) >= 1.0 * weight * (total - held)
  ORDER BY 3.0 * source_size / weight, source LIMIT 1
), targets AS (
  SELECT source, source_size,
         CASE WHEN weight * shared / free::DOUBLE > 3 * source_size THEN (3 * source_size)::DOUBLE
              ELSE weight * shared / free::DOUBLE END AS target
  FROM sources, level
), placed AS (
  SELECT k.doc_id, k.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size ROWS UNBOUNDED PRECEDING) AS reach
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN reach - size / 2.0::DOUBLE <= target - epochs * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""

QUERIES = {"op8_mixing": op8_mixing}
ORACLES = {"op8_mixing": MIX_SQL}
