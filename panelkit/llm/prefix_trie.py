"""Conversation prefix trie: every distinct beginning of a conversation is a node.

The digest of a beginning is the exclusive-or of its turns' hashes, each tagged with its place, so
it follows from running sums and a node's parent from its last turn. Nodes are counted by digest.
Sums over subtrees are taken in shards of whole paths: a shard lists its distinct digests, gives each
a slot by a minimal perfect hash whose answers are checked against the digests, scatters what its
conversations own into flat arrays, and adds each slot into its parent's from the deepest up. A node
is owned by its smallest member only, so the shards' sums add up to the whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.llm.common import remainder, table
from panelkit.llm.sql import crc32, crc_table
from panelkit.storage import stage

#: Conversations share the first turns of the one whose id ends in 00, up to five.
FAMILY, SHARED = 100, 6
#: Turns of a conversation that are worked on together; longer ones are cut.
BLOCK = 512
#: Turns a shard holds, about.
SHARD_ROWS = 200_000
NO_ENDS = hashlib.sha256(b"").hexdigest()


# ------------------------------------------------------------------------------ slots of digests


def _mixed(p: np.ndarray, q: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of both halves of each digest, another one for each level."""
    def spread(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    step = np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    return spread(spread(p.view(np.uint64) + step) + q.view(np.uint64))


class SlotTable:
    """A minimal perfect hash of distinct digests: n digests get the slots 0 to n - 1.

    Level by level, digests that fall alone into one of twice as many places as are left take it;
    a slot is the number of taken places before. The digest of every slot is kept and compared.
    """

    def __init__(self, p: np.ndarray, q: np.ndarray):
        self.levels, taken = [], 0
        rest = np.arange(len(p))
        while len(rest):
            at = self._places(p[rest], q[rest], len(self.levels), size := max(64, 2 * len(rest)))
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append((size, alone, taken - 1 + np.cumsum(alone)))
            taken += int(alone.sum())
            rest = rest[~alone[at]]
        self.p, self.q = np.empty_like(p), np.empty_like(q)
        slots = self._find(p, q)
        self.p[slots], self.q[slots] = p, q
        if not (np.array_equal(self.p[slots], p) and np.array_equal(self.q[slots], q)):
            raise ValueError("two digests share a slot")

    @staticmethod
    def _places(p: np.ndarray, q: np.ndarray, level: int, size: int) -> np.ndarray:
        return (_mixed(p, q, level) % np.uint64(size)).astype(np.int64)

    def _find(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        out, rest = np.full(len(p), -1), np.arange(len(p))
        for level, (size, alone, rank) in enumerate(self.levels):
            at = self._places(p[rest], q[rest], level, size)
            hit = alone[at]
            out[rest[hit]] = rank[at[hit]]
            rest = rest[~hit]
        return out

    def slots(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for those that the table does not hold."""
        out = self._find(p, q)
        held = np.maximum(out, 0)
        known = (out >= 0) & (self.p[held] == p) & (self.q[held] == q) if len(self.p) else out >= 0
        return np.where(known, out, -1)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def shard_sums(paths: pa.Table, owned: pa.Table) -> dict[str, np.ndarray]:
    """Sums over the subtrees of all prefixes in `paths`, of what the rows of `owned` bring.

    `paths` has the digest (p, q), the parent's (up_p, up_q) and the depth of prefixes, repeats
    included; `owned` has leaves, saved and children for some digests. Children are counted at the
    parent; a parent outside of the shard gets a result row of its own.
    """
    p, q, depth = (_column(paths, c) for c in ("p", "q", "depth"))
    order = np.lexsort((q, p))
    first = np.ones(len(p), bool)
    first[1:] = (np.diff(p[order]) != 0) | (np.diff(q[order]) != 0)
    one = order[first]
    slots = SlotTable(p[one], q[one])
    at = slots.slots(p[one], q[one])
    n = len(one)
    level, up_p, up_q = (np.empty(n, np.int64) for _ in range(3))
    level[at], up_p[at], up_q[at] = depth[one], _column(paths, "up_p")[one], _column(paths, "up_q")[one]
    parent = np.where(level > 0, slots.slots(up_p, up_q), -1)
    sums = {c: np.zeros(n, np.int64) for c in ("leaves", "saved", "children")}
    mine = slots.slots(_column(owned, "p"), _column(owned, "q"))
    if (mine < 0).any():
        raise ValueError("a node is owned outside of its shard")
    for c in ("leaves", "saved"):
        np.add.at(sums[c], mine, _column(owned, c))
    counts = _column(owned, "children")
    inside = parent[mine] >= 0
    np.add.at(sums["children"], parent[mine[inside]], counts[inside])
    deepest_first = np.argsort(-level, kind="stable")
    ends = np.flatnonzero(np.diff(level[deepest_first])) + 1
    for same_depth in np.split(deepest_first, ends):
        same_depth = same_depth[parent[same_depth] >= 0]
        for c in ("leaves", "saved"):
            np.add.at(sums[c], parent[same_depth], sums[c][same_depth])
    outside = mine[(~inside) & (counts > 0) & (level[mine] > 0)]
    none = np.zeros(len(outside), np.int64)
    return {
        "p": np.concatenate([slots.p, up_p[outside]]), "q": np.concatenate([slots.q, up_q[outside]]),
        "depth": np.concatenate([level, level[outside] - 1]),
        "leaves": np.concatenate([sums["leaves"], none]), "saved": np.concatenate([sums["saved"], none]),
        "children": np.concatenate([sums["children"], none + 1]),
    }


# ------------------------------------------------------------------------------ rebuilt turns


def _tags(place: Column, a: Column, b: Column) -> tuple[Column, Column]:
    return F.xxhash64(place, a, b), F.xxhash64(F.lit(1), b, place, a)


def placed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, length, a, b, chars): a and b are hashes of role and text.

    Turns are numbered in blocks of turn numbers, and blocks follow on from each other.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    block = F.coalesce(F.floor(F.col("turn") / BLOCK).cast("long"), F.lit(-(1 << 62)))
    thin = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", block.alias("block"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), text, role).alias("b"),
        F.length(text).alias("chars"),
    )
    inside = W.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "a", "b")
    turns = stage(thin.withColumn("n", F.row_number().over(inside)).drop("turn"), "turns")
    whole = W.partitionBy("conv_id")
    before = F.sum("held").over(whole.orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    blocks = turns.groupBy("conv_id", "block").agg(F.count("*").alias("held")).select(
        "conv_id", "block", F.coalesce(before, F.lit(0)).alias("before"),
        F.sum("held").over(whole).alias("length"),
    )
    return turns.join(blocks, ["conv_id", "block"]).select(
        "conv_id", (F.col("before") + F.col("n")).alias("pos"), "length", "a", "b", "chars"
    )


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns after the first turns were replaced by those of the family's head, and the lengths.

    Conversation c takes the first h turns of c - c % 100, all if fewer, then its own after its
    first h; h is crc32 of c's digits modulo 6. A head adds five rows at most to each of its family.
    """
    base, h = F.col("conv_id") - F.col("conv_id") % FAMILY, remainder(F.col("conv_id"), SHARED)
    heads = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < SHARED)).groupBy(
        F.col("conv_id").alias("base")
    ).agg(F.sort_array(F.collect_list(F.struct("pos", "a", "b", "chars"))).alias("head"))
    none = F.array().cast(heads.schema["head"].dataType)
    ids = turns.select("conv_id", "length").distinct().withColumns({"base": base, "h": h})
    taken = F.slice(F.coalesce("head", none), F.lit(1), F.col("h").cast("int"))
    families = stage(
        ids.join(heads, "base", "left").select("conv_id", "length", "h", taken.alias("head")),
        "families",
    )
    own = F.greatest(F.col("length") - F.col("h"), F.lit(0))
    lengths = families.select("conv_id", (F.size("head") + own).alias("length"))
    kept = turns.drop("length").join(
        families.select("conv_id", "h", F.size("head").alias("m")), "conv_id"
    ).filter("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "a", "b", "chars"
    )
    return families.select("conv_id", F.inline("head")).unionByName(kept), lengths


def prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, depth, p, q, up_p, up_q, a, b, chars, ends): one row per beginning, root included.

    Running sums are taken in blocks of turns; each block carries on those before.
    """
    x, y = _tags(F.col("pos"), F.col("a"), F.col("b"))
    tagged = turns.withColumns({"x": x, "y": y, "block": F.floor((F.col("pos") - 1) / BLOCK)})
    inside = W.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    running = stage(
        tagged.withColumns({"p": F.bit_xor("x").over(inside), "q": F.bit_xor("y").over(inside)})
        .drop("x", "y"), "running_digests",
    )
    before = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = running.groupBy("conv_id", "block").agg(
        F.max_by("p", "pos").alias("p"), F.max_by("q", "pos").alias("q")
    ).select(
        "conv_id", F.col("block").alias("of_block"),
        F.bit_xor("p").over(before).alias("from_p"), F.bit_xor("q").over(before).alias("from_q"),
    ).filter("of_block > 0")
    first = running.filter("block = 0").withColumns({"from_p": F.lit(0), "from_q": F.lit(0)})
    later = running.filter("block > 0").join(
        carried, (running["conv_id"] == carried["conv_id"]) & (running["block"] == carried["of_block"])
    ).drop(carried["conv_id"]).drop("of_block")
    whole = first.unionByName(later).withColumns({
        "p": F.col("p").bitwiseXOR(F.col("from_p")), "q": F.col("q").bitwiseXOR(F.col("from_q")),
    })
    zero = F.lit(0).cast("long")
    rows = whole.select("conv_id", F.col("pos").alias("depth"), "p", "q", "a", "b", "chars").unionByName(
        lengths.select("conv_id", *[zero.alias(c) for c in ("depth", "p", "q", "a", "b")],
                       F.lit(0).alias("chars"))
    )
    return rows.join(lengths, "conv_id").select(
        "conv_id", "depth", "p", "q", *_parent(), "a", "b", "chars",
        (F.col("depth") == F.col("length")).alias("ends"),
    )


def _parent() -> tuple[Column, Column]:
    x, y = _tags(F.col("depth"), F.col("a"), F.col("b"))
    deep = F.col("depth") > 0
    return (
        F.when(deep, F.col("p").bitwiseXOR(x)).otherwise(0).alias("up_p"),
        F.when(deep, F.col("q").bitwiseXOR(y)).otherwise(0).alias("up_q"),
    )


# ------------------------------------------------------------------------------ nodes


def _nodes(rows: DataFrame) -> DataFrame:
    """One row per digest; members that disagree on the last turn or the parent are an error."""
    same = [F.struct("up_p", "up_q", "a", "b", "chars")]
    counted = rows.groupBy("p", "q", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.count_if("ends").alias("n_ends"), F.min(*same).alias("low"), F.max(*same).alias("high"),
    )
    checked = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(
        F.raise_error(F.lit("two beginnings share a digest"))
    )
    return counted.withColumn("one", checked).select(
        "p", "q", "depth", "conv_id", "n_convs", "n_ends", "one.up_p", "one.up_q",
        ((F.col("n_convs") - 1) * F.col("one.chars")).alias("saved"),
        (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaves"),
    )


def _ends(rows: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each node; ids stream through in order, none are gathered."""
    node = ["p", "q", "depth"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        for batch in batches:
            done = []
            for row in zip(*(batch.column(c).to_pylist() for c in (*node, "conv_id")), strict=True):
                if row[:3] != held:
                    if state:
                        done.append((*held, state.hexdigest()))
                    held, state = row[:3], hashlib.sha256(b"%d" % row[3])
                else:
                    state.update(b",%d" % row[3])
            yield _batch(done)
        if state:
            yield _batch([(*held, state.hexdigest())])

    def _batch(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) if done else [[]] * 4
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], [*node, "ends_sha256"]
        )

    ended = rows.filter("ends").select(*node, "conv_id")
    return ended.repartition(*node).sortWithinPartitions(*node, "conv_id").mapInArrow(
        digest, "p long, q long, depth long, ends_sha256 string"
    )


def _subtree_sums(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(p, q, depth, leaves, saved, children) of every node, from the shards' sums."""
    shards = rows.count() // SHARD_ROWS + 1
    block = F.floor(F.col("depth") / BLOCK)

    def keyed(df: DataFrame, *columns) -> DataFrame:
        shard = F.pmod(F.xxhash64("conv_id", F.lit("shard")), F.lit(shards))
        return df.select(block.alias("block"), shard.alias("shard"), *columns)

    what = ("p", "q", "leaves", "saved", "children")
    owned = keyed(nodes.withColumn("children", (F.col("depth") > 0).cast("long")), *what)
    # What a path owns in later blocks comes in at its last turn of this one.
    later = W.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)
    blocks = nodes.withColumn("block", block).groupBy("conv_id", "block").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )
    rest = blocks.select(
        "conv_id", "block", F.sum("leaves").over(later).alias("leaves"),
        F.sum("saved").over(later).alias("saved"),
    ).filter("leaves IS NOT NULL")
    # Blocks before the first that a path owns anything in get all it owns.
    whole = blocks.groupBy("conv_id").agg(
        F.min("block").alias("least"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    ).filter("least > 0").select(
        "conv_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("least") - 1)).alias("block"),
        "leaves", "saved",
    )
    carried = rest.unionByName(whole)
    lasts = rows.filter(F.col("depth") % BLOCK == BLOCK - 1).select(
        "conv_id", "depth", "p", "q", block.alias("block")
    ).join(carried, ["conv_id", "block"]).withColumn("children", F.lit(0).cast("long"))
    owned = owned.unionByName(keyed(lasts, *what))
    paths = keyed(rows, "p", "q", "up_p", "up_q", "depth")

    def sums(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.table(shard_sums(left, right))

    return (
        paths.groupBy("block", "shard").cogroup(owned.groupBy("block", "shard"))
        .applyInArrow(sums, "p long, q long, depth long, leaves long, saved long, children long")
        .groupBy("p", "q", "depth")
        .agg(*[F.sum(c).alias(c) for c in ("leaves", "saved", "children")])
    )


def prefix_trie(conversations: DataFrame, rebuild: bool = True) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, and the digest (p, q).

    `conversations` has conv_id, turn, role and text; other columns are not read. With `rebuild`
    conversations first get their family's turns (`rebuilt_turns`); without, they are as they are.

    Rows without conv_id belong to no conversation and are left out. Null turns come first; null
    role or text is empty; turns with equal numbers are ordered by hashes of role and text, so row
    order never matters, and repeated rows are turns of their own. Turns share memory with 511
    others at most unless their numbers are equal or null; very long texts only leave their hash and
    length. An empty table gives no rows, and no root.
    """
    turns = placed_turns(conversations)
    if rebuild:
        turns, lengths = rebuilt_turns(stage(turns, "placed_turns"))
    else:
        turns = stage(turns, "placed_turns")
        turns, lengths = turns.drop("length"), turns.select("conv_id", "length").distinct()
    rows = stage(prefixes(turns, lengths), "beginnings")
    nodes = stage(_nodes(rows), "trie_nodes")
    node = ["p", "q", "depth"]
    parents = nodes.select(
        F.col("p").alias("up_p"), F.col("q").alias("up_q"), (F.col("depth") + 1).alias("depth"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    return (
        nodes.drop("leaves", "saved").join(_subtree_sums(rows, nodes), node)
        .join(_ends(rows), node, "left").join(parents, ["up_p", "up_q", "depth"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"), "p", "q",
        )
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations.

    Null, very long and repeated rows, ties and empty tables: as `prefix_trie` states.
    """
    return prefix_trie(table(spark, sf_dir, "conversations")).drop("p", "q")


TRIE_SQL = f"""
WITH {crc_table()}, turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, list_slice(head, 1, h) AS head, h
  FROM (SELECT conv_id, conv_id - conv_id % {FAMILY} AS base, {crc32("conv_id::VARCHAR")} % {SHARED} AS h
        FROM (SELECT DISTINCT conv_id FROM turns), crc_table)
  LEFT JOIN (SELECT conv_id AS base, list({{'role': role, 'text': text}} ORDER BY pos) AS head
             FROM turns WHERE conv_id % {FAMILY} = 0 GROUP BY conv_id) USING (base)
), lists AS (
  SELECT c.conv_id, coalesce(any_value(head), []) || coalesce(
    list({{'role': role, 'text': text}} ORDER BY pos) FILTER (pos > h), []) AS said
  FROM convs c JOIN turns t USING (conv_id) GROUP BY c.conv_id
), beginnings AS (
  SELECT conv_id, depth, len(said) = depth AS ends, said[1:depth] AS node, said[1:depth - 1] AS up,
         CASE WHEN depth > 0 THEN length(said[depth].text) ELSE 0 END AS chars
  FROM (SELECT conv_id, said, unnest(range(len(said) + 1)) AS depth FROM lists)
), keyed AS (
  SELECT conv_id, depth, ends, chars, sha256(node::VARCHAR) AS node, sha256(up::VARCHAR) AS up FROM beginnings
), nodes AS (
  SELECT node, any_value(up) AS up, depth, min(conv_id) AS owner, count(*) AS n_convs,
         count(*) FILTER (ends) AS n_ends, any_value(chars) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM keyed GROUP BY node, depth
), owned AS (
  SELECT k.node, k.conv_id, k.depth, CASE WHEN n.owner = k.conv_id THEN (n_convs - 1) * n.chars ELSE 0 END AS saved,
         CASE WHEN n.owner = k.conv_id AND n_convs = n_ends THEN 1 ELSE 0 END AS leaf
  FROM keyed k JOIN nodes n USING (node, depth)
), below AS (
  SELECT node, depth, sum(saved) OVER w AS saved, sum(leaf) OVER w AS leaf FROM owned
  WINDOW w AS (PARTITION BY conv_id ORDER BY depth DESC ROWS UNBOUNDED PRECEDING)
), sums AS (SELECT node, depth, sum(saved) AS saved_tokens, sum(leaf) AS n_leaves FROM below GROUP BY node, depth)
SELECT n.owner AS conv_id, n.depth, u.owner AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (node, depth)
LEFT JOIN nodes u ON u.node = n.up AND u.depth = n.depth - 1
LEFT JOIN (SELECT up, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY up, depth) c
  ON c.up = n.node AND c.depth = n.depth
"""

QUERIES = {"op13_prefix_trie": op13_prefix_trie}
ORACLES = {"op13_prefix_trie": TRIE_SQL}
