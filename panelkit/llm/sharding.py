"""Histogram sort into shards of near equal bytes.

Rows are ordered by a key of hexadecimal digits: a hash of the text, then of the id, then of the
row's place. A cell is all keys that begin alike. Bytes and rows are counted per cell over all
partitions; each round only refines cells that a shard boundary runs through, and hot ones, until
every boundary stands where the tolerance lets it stand. Then rows move once, straight to their cell:
how many rows come before a cell is known exactly, so a row's slot needs its own cell only.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.llm.common import table
from panelkit.llm.sql import crc32, crc_table
from panelkit.storage import stage

SHARDS = 24
#: Bytes that each row counts beside its text.
ROW_BYTES = 8
#: Digits of the key: text, id, place.
TEXT_DIGITS, ID_DIGITS, PLACE_DIGITS = 15, 16, 8
#: Digits that tell the first cells apart, and by which cells are refined.
FIRST, STEP = 3, 2
#: A boundary may move by this part of a shard to keep equal texts together.
TOLERANCE = 100
#: Cells with more than this part of all rows are refined, so no task gets more.
HOT = 512


def shard_key(text: Column, doc_id: Column) -> Column:
    """Equal texts are neighbours, in the order of their ids' hashes; null counts as empty."""
    def digits(value: Column, n: int) -> Column:
        return F.substring(F.md5(F.coalesce(value, F.lit("")).cast("binary")), 1, n)

    place = F.monotonically_increasing_id().cast("string")
    return F.concat(
        digits(text, TEXT_DIGITS), digits(doc_id.cast("string"), ID_DIGITS), digits(place, PLACE_DIGITS)
    )


@dataclass
class Cells:
    """The cells so far, in key order, and which of them were refined, by length and new length."""

    found: dict[str, tuple[int, int, str, str]]
    refined: dict[tuple[int, int], list[str]] = field(default_factory=dict)

    def leaf(self, key: Column) -> Column:
        """The cell that a key is in: that of the deepest refinement."""
        out = F.substring(key, 1, FIRST)
        for (held, now), prefixes in sorted(self.refined.items()):
            inside = F.substring(key, 1, held).isin(prefixes)
            out = F.when(inside, F.substring(key, 1, now)).otherwise(out)
        return out


def _counted(rows: DataFrame, cell: Column) -> dict[str, tuple[int, int, str, str]]:
    """Bytes, rows, smallest and largest key per cell; the number of cells bounds what arrives."""
    counted = rows.select(cell.alias("cell"), "_key", "_bytes").filter("cell IS NOT NULL").groupBy("cell").agg(
        F.sum("_bytes"), F.count("*"), F.min("_key"), F.max("_key")
    )
    return {r[0]: tuple(r[1:]) for r in counted.collect()}


def _finer(low: str, high: str, held: int) -> int:
    """The next length of prefixes that tells `low` from `high`."""
    common = next(i for i, (a, b) in enumerate(zip(low, high, strict=True)) if a != b)
    return max(held + STEP, FIRST + (common + 1 - FIRST + STEP - 1) // STEP * STEP)


def split_points(cells: dict[str, tuple], shards: int) -> tuple[list[int], set[str]]:
    """Bytes below each inner boundary, and the cells to be refined before these are final.

    A boundary comes after the group of equal texts that its target falls into, if that moves it by
    the tolerance at most, else after the row that its target falls into.
    """
    names = sorted(cells)
    ends = list(accumulate(cells[name][0] for name in names))
    if not names:
        return [], set()
    total = ends[-1]
    scaled, most = [e * shards for e in ends], total // shards // TOLERANCE
    points, open_cells = [], set()
    # The group that a cell belongs to may have been refined: its end is that of its last cell.
    group_end = {}
    for name, end in zip(names, ends, strict=True):
        if len(name) > TEXT_DIGITS:
            group_end[name[:TEXT_DIGITS]] = end
    for j in range(1, shards):
        at = bisect_left(scaled, j * total)
        name, end = names[at], ends[at]
        _, _, low, high = cells[name]
        if low[:TEXT_DIGITS] != high[:TEXT_DIGITS]:
            group = None
        else:
            group = group_end[low[:TEXT_DIGITS]] if len(name) > TEXT_DIGITS else end
        if end * shards == j * total:
            close = end
        elif group is not None and (group - most) * shards <= j * total:
            close = group
        else:
            close = end if low == high else None
        points.append(end if close is None else close)
        if close is None:
            open_cells.add(name)
    return points, open_cells


def histogram(rows: DataFrame, shards: int) -> tuple[Cells, list[int]]:
    """Refine cells until all boundaries are final and no cell is hot."""
    cells = Cells(_counted(rows, F.substring("_key", 1, FIRST)))
    hot = sum(c[1] for c in cells.found.values()) // HOT + 1
    while True:
        points, more = split_points(cells.found, shards)
        more |= {n for n, (_, count, low, high) in cells.found.items() if count > hot and low != high}
        if not more:
            return cells, points
        asked: dict[tuple[int, int], list[str]] = {}
        for name in more:
            _, _, low, high = cells.found.pop(name)
            asked.setdefault((len(name), _finer(low, high, len(name))), []).append(name)
        child = F.lit(None).cast("string")
        for (held, now), prefixes in asked.items():
            inside = F.substring("_key", 1, held).isin(prefixes)
            child = F.when(inside, F.substring("_key", 1, now)).otherwise(child)
            cells.refined.setdefault((held, now), []).extend(prefixes)
        cells.found |= _counted(rows, child)


def sharded(
    docs: DataFrame,
    shards: int = SHARDS,
    size: Column | None = None,
    key: Column | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Every row of `docs` with shard (0 to shards - 1) and slot (0, 1, ... in each shard).

    `docs` has doc_id and text, or `size` and `key` are given. Sizes are UTF-8 bytes plus eight. A
    shard ends after the row at which its share of all bytes is reached; where a group of equal
    texts goes on there for no more than a hundredth of a shard, it ends with the group. So shards
    differ from the mean by that and one row at most, and only groups that are larger are split.

    Null texts and ids count as empty; repeated rows are told apart by their place and stand side by
    side; very long texts are rows like others, the shard that reaches its share in one ends after
    it; an empty table gives no rows. `keep` names the columns to carry (all by default); those named
    shard or slot are replaced. Rows are written once with their keys, read for every round's sums,
    and exchanged once.
    """
    kept = [c for c in keep or docs.columns if c not in ("shard", "slot")]
    if size is None:
        size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES
    if key is None:
        key = shard_key(F.col("text"), F.col("doc_id"))
    rows = stage(
        docs.select(F.struct(*kept).alias("_row"), size.alias("_bytes"), key.alias("_key")),
        "keyed_rows",
    )
    cells, points = histogram(rows, shards)
    leaves, below, shard_rows = [], 0, {}
    for leaf in sorted(cells.found):
        held, count, _, _ = cells.found[leaf]
        shard = bisect_right(points, below)
        leaves.append((leaf, shard, shard_rows.get(shard, 0)))
        shard_rows[shard] = shard_rows.get(shard, 0) + count
        below += held
    known = docs.sparkSession.createDataFrame(leaves, "leaf string, shard int, before long")
    inside = F.row_number().over(W.partitionBy("leaf").orderBy("_key"))
    return (
        rows.withColumn("leaf", cells.leaf(F.col("_key"))).join(known, "leaf")
        .withColumn("slot", F.col("before") + inside - 1).select("_row.*", "shard", "slot")
    )


def write_shards(placed: DataFrame, folder: str) -> None:
    """One folder per shard, `shard=0` and so on; rows carry their slot."""
    placed.write.partitionBy("shard").parquet(folder)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards by bytes; only sizes, checksums and keys travel, texts stay.

    Null, empty, very long and repeated rows, and empty tables: as `sharded` states.
    """
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    thin = docs.select(
        "doc_id", (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_key(F.col("text"), F.col("doc_id")).alias("key"),
    )
    return sharded(
        thin, size=F.col("size"), key=F.col("key"), keep=["doc_id", "size", "text_crc32"]
    ).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


SHARDING_SQL = f"""
WITH {crc_table()}, keyed AS (
  SELECT doc_id, strlen(coalesce(text, '')) + {ROW_BYTES} AS size, coalesce(text, '') AS text,
         substr(md5(coalesce(text, '')), 1, {TEXT_DIGITS}) AS grp,
         substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {ID_DIGITS}) AS place
  FROM documents
), reached AS (
  SELECT *, sum(size) OVER (ORDER BY grp, place, doc_id ROWS UNBOUNDED PRECEDING) - size AS start,
         sum(size) OVER (ORDER BY grp) AS group_end, sum(size) OVER () AS total
  FROM keyed
), placed AS (
  SELECT *, (group_end - sum(size) OVER (PARTITION BY grp)) AS group_start,
         total // {SHARDS} // {TOLERANCE} AS most
  FROM reached
), chosen AS (
  SELECT *, least({SHARDS - 1}, greatest(group_start * {SHARDS} // total, least(start * {SHARDS} // total,
         ((group_end - most) * {SHARDS} - 1) // total)))::INTEGER AS shard
  FROM placed
), sums AS (SELECT text, {crc32("text")} AS text_crc32 FROM (SELECT DISTINCT text FROM keyed), crc_table)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY grp, place, doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM chosen JOIN sums USING (text)
"""

QUERIES = {"op12_sharding": op12_sharding}
ORACLES = {"op12_sharding": SHARDING_SQL}
