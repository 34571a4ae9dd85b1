"""Target-distribution importance resampling on hashed words and word pairs.

Texts are scanned by an Aho-Corasick automaton whose entries are the distinct words of a slice of
text, each between two delimiters and carrying its CRC-32 and its length. A scan emits the payloads
of all words in order. The CRC of two words joined by a space follows from their payloads alone
(CRC-32 is linear: appending n bytes is a fixed bit matrix for each n), so neither pairs nor words are
hashed again. Buckets are counted over all rows of both tables, and one more scan sums the gains.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.common import slices, table
from panelkit.llm.sql import crc32, crc_table
from panelkit.storage import stage

BUCKETS, PERCENT, LEAST_WORDS, SEED = 10_000, 25, 20, 7
#: Longer words stand in the automaton under a short mark, so that its size follows the text's.
LONGEST = 256
#: Bytes of text that one automaton serves; its nodes then stay near the processor.
SCANNED_BYTES = 1 << 20
#: Fixed value: words are runs of digits, letters a-z and bytes of 0x80 and above.
TO_SPACE = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
LOW_32 = (1 << 32) - 1


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (
        tables[0][crc & 255] ^ tables[1][(crc >> 8) & 255]
        ^ tables[2][(crc >> 16) & 255] ^ tables[3][crc >> 24]
    )


@lru_cache(maxsize=1)
def _appended() -> list[np.ndarray]:
    """How a CRC changes when 2^k zero bytes follow, for k = 0 to 31, as four tables by byte."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(0xEDB88320), byte >> 1)
    alone = np.arange(256, dtype=np.uint32)
    places = [alone << np.uint32(8 * j) for j in range(4)]
    tables = [np.stack([(c >> 8) ^ byte[c & 255] for c in places])]
    while len(tables) < 32:
        tables.append(np.stack([_apply(tables[-1], row) for row in tables[-1]]))
    return tables


def shifted(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRCs moved on by as many bytes: xor with the CRC of those bytes gives that of the whole."""
    out, bit = crc.copy(), 0
    while (lengths >> bit).any():
        at = np.flatnonzero((lengths >> bit) & 1)
        out[at] = _apply(_appended()[bit], out[at])
        bit += 1
    return out


def _dictionary(joined: bytes) -> tuple[bytes, ahocorasick.Automaton | None]:
    """The automaton of the distinct words of `joined`, and the text to be scanned by it."""
    words = set(joined.split())
    entries = {w: w for w in words if len(w) <= LONGEST}
    if len(entries) < len(words):
        marks: dict[bytes, bytes] = {}

        def mark(found: re.Match[bytes]) -> bytes:
            return marks.setdefault(found.group(), b"\x01%d" % len(marks))

        joined = re.sub(rb"[^ \n]{%d,}" % (LONGEST + 1), mark, joined)
        entries |= {short: w for w, short in marks.items()}
    if not entries:
        return joined, None
    automaton = ahocorasick.Automaton()
    for entry, word in entries.items():
        automaton.add_word(f" {entry.decode('latin-1')} ", len(word) << 32 | zlib.crc32(word))
    automaton.make_automaton()
    return joined, automaton


def scan(texts: Sequence[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """CRCs of all words of `texts`, CRCs of the pairs they begin, whether a word begins a pair
    inside its text, and where in these arrays each text starts (one place more than texts)."""
    joined = b"\n".join(
        b" " + text.lower().translate(TO_SPACE) + b" " if text else b"" for text in texts
    )
    joined, automaton = _dictionary(joined)
    if automaton is None:
        none = np.zeros(0, np.uint32)
        return none, none, none.astype(bool), np.zeros(len(texts) + 1, np.int64)
    matches = automaton.iter(joined.decode("latin-1"))
    found = np.fromiter(chain.from_iterable(matches), np.int64)
    ends, payload = found[0::2], found[1::2]
    crc, length = (payload & LOW_32).astype(np.uint32), payload >> 32
    breaks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 10)
    starts = np.concatenate([[0], np.searchsorted(ends, breaks), [len(ends)]])
    spaced = _apply(_appended()[0], crc) ^ np.uint32(zlib.crc32(b" "))
    pairs = np.zeros_like(crc)
    pairs[:-1] = shifted(spaced[:-1], length[1:]) ^ crc[1:]
    begins = np.ones(len(crc), bool)
    last = starts[1:][starts[1:] > starts[:-1]] - 1
    begins[last] = False
    return crc, pairs, begins, starts


def bucket_counts(texts: DataFrame, column: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows. Tasks add up before the exchange; `buckets` sums arrive."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices([batch], "text", SCANNED_BYTES):
                crc, pairs, begins, _ = scan(part.column("text").to_pylist())
                for found in (crc, pairs[begins]):
                    total += np.bincount(found % buckets, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    counted = (
        texts.select(F.col(column).cast("binary").alias("text"))
        .mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    )
    out = np.zeros(buckets, np.int64)
    for row in counted.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much likelier the target is in each bucket, add-one smoothed."""
    s, t = raw.astype(float), target.astype(float)
    whole_s, whole_t = float(raw.sum()) + len(raw), float(target.sum()) + len(raw)
    ratio = (t + 1.0) * whole_s / ((s + 1.0) * whole_t)
    return np.floor(1000.0 * np.log(ratio)).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, keep: Sequence[str]) -> DataFrame:
    """(row, n_words, n_features, weight): `row` has the columns named by `keep`."""
    buckets = len(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], "text", SCANNED_BYTES):
                crc, pairs, begins, starts = scan(part.column("text").to_pylist())
                total = gain[crc % buckets] + gain[pairs % buckets] * begins
                reach = np.concatenate([[0], np.cumsum(total)])
                words = np.diff(starts)
                features = words + np.maximum(words - 1, 0)
                sums = reach[starts[1:]] - reach[starts[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(words), pa.array(features),
                     pa.array(sums // np.maximum(features, 1))],
                    ["row", "n_words", "n_features", "weight"],
                )

    inputs = docs.select(F.struct(*keep).alias("row"), F.col("text").cast("binary").alias("text"))
    schema = T.StructType([inputs.schema["row"]] + [
        T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")
    ])
    return inputs.mapInArrow(weigh, schema)


def numbered(rows: DataFrame, order: Sequence, name: str) -> DataFrame:
    """`rows` with `rank` from 1 in `order`, sorted by ranges: no task sees more than its own range."""
    at = stage(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()), name,
    ).withColumn("_part", F.shiftright("_at", 33))
    inside = F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    # One row per range.
    before = F.sum("n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    ranges = at.groupBy("_part").agg(F.max(inside).alias("n")).select(
        "_part", F.coalesce(before, F.lit(0)).alias("_before")
    )
    return at.join(ranges, "_part").withColumn("rank", F.col("_before") + inside).drop(
        "_at", "_part", "_before"
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Every row of `docs` with n_features, weight, score and rank; undrawn rows have no rank.

    `docs` has doc_id and text, `target` has text. Features are words and pairs of neighbours.
    The weight is the floored mean of a document's gains; a Gumbel number drawn from the id is added,
    so the highest scores are a sample without replacement in proportion to exp(weight / 1000).
    Of the documents with `least_words` words or more, `percent` are drawn. Scores are whole numbers
    in a range that the formula bounds, so a histogram finds the lowest score drawn; only rows at or
    above it are sorted.

    Null and empty texts have no features, weight 0, and are not drawn. A null id draws as an empty
    one and comes last among ties. Rows that share id and score are ordered by their features. Very
    long texts are scanned whole, in a slice of their own; very long words have an entry of their own.
    An empty table gives no rows; an empty target gives every bucket its add-one share. `keep` names
    the columns to carry (all by default); those named like the four results are replaced.
    """
    new = ("n_features", "weight", "score", "rank")
    kept = [c for c in keep or docs.columns if c not in new]
    gain = gains(bucket_counts(docs, buckets=buckets), bucket_counts(target, buckets=buckets))
    ident = F.coalesce(F.col("row.doc_id").cast("string"), F.lit(""))
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), ident), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 32)
    scored = stage(
        weighed(docs, gain, list(dict.fromkeys(["doc_id", *kept])))
        .withColumn("score", F.col("weight") + F.floor(-1000.0 * F.log(-F.log(u))))
        .withColumn("_tie", F.monotonically_increasing_id()),
        "scored_documents",
    )
    able = F.col("n_words") >= least_words
    # One row per score.
    levels = scored.filter(able).groupBy("score").agg(F.count("*").alias("n"))
    drawn = (levels.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) * percent // 100
    reach = F.sum("n").over(W.orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, 0))
    lowest = levels.withColumn("reach", reach).filter(F.col("reach") >= drawn).agg(F.max("score")).first()[0]
    high = able & (F.col("score") >= lowest) if drawn else F.lit(False)
    results = ["n_features", "weight", "score", "rank"]
    order = [F.desc("score"), F.asc_nulls_last("row.doc_id"), F.asc("n_features"), F.asc("_tie")]
    ranked = numbered(scored.filter(high), order, "highest_scores").withColumn(
        "rank", F.when(F.col("rank") <= drawn, F.col("rank"))
    )
    rest = scored.filter(~high).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(*[F.col("row")[c].alias(c) for c in kept], *results)


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against the benchmark: doc_id, n_features, weight, score, rank.

    Null, empty, very long and repeated rows, ties and empty tables: as `resample` states.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])


RESAMPLING_SQL = rf"""
WITH {crc_table()}, texts AS (
  SELECT doc_id, 0 AS goal, text FROM documents UNION ALL SELECT NULL, 1, text FROM benchmark
), numbered AS (
  SELECT row_number() OVER () AS r, doc_id, goal, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS words
  FROM texts
), features AS (
  SELECT r, goal, unnest(words || list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS feature
  FROM numbered
), counted AS (
  SELECT feature, sum(1 - goal) AS s, sum(goal) AS t FROM features GROUP BY feature
), hashed AS (
  SELECT feature, s, t, {crc32("feature")} % 10000 AS bucket FROM counted, crc_table
), sums AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM counted
), buckets AS (
  SELECT bucket, floor(1000.0::DOUBLE * ln((sum(t)::DOUBLE + 1) * (s_all + 10000) / ((sum(s)::DOUBLE + 1) * (t_all + 10000))))::BIGINT AS gain
  FROM hashed, sums GROUP BY bucket, s_all, t_all
), weights AS (
  SELECT r, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM features JOIN hashed USING (feature) JOIN buckets USING (bucket) WHERE goal = 0 GROUP BY r
), scored AS (
  SELECT doc_id, len(words) AS n, (len(words) + greatest(len(words) - 1, 0))::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000.0::DOUBLE * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
           + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM numbered LEFT JOIN weights USING (r) WHERE goal = 0
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
         sum(CASE WHEN n >= 20 THEN 1 ELSE 0 END) OVER () AS able
  FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n >= 20 AND place <= floor(able * 25 / 100) THEN place END AS rank
FROM ordered
"""

QUERIES = {"op11_resampling": op11_resampling}
ORACLES = {"op11_resampling": RESAMPLING_SQL}
