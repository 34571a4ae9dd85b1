"""Near-duplicate vectors through a pivot-permutation index.

A vector is described by its nearest reference points (pivots) in order. It is posted in the
inverted list of each of them; two vectors are candidates if they share enough pivots, counted
inside the lists, and every candidate is verified by its cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import table
from panelkit.llm.components import components
from panelkit.storage import stage

COSINE = 0.95
#: Reference points: one for so many vectors, between the two bounds.
VECTORS_PER_PIVOT, FEWEST, MOST = 32, 32, 4096
#: Pivots closer to one another than this cosine are one: a large group of near copies would
#: else have many pivots of its own, and its members would not share them.
APART = 0.7
#: Length of a vector's permutation prefix, and the pivots two candidates must share.
PREFIX, SHARED = 6, 2
#: Postings of a list that meet in one task; longer lists are cut into chunks that meet by twos.
CHUNK = 1024


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that may link: finite numbers, not all zero, with an id."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
        .filter("vec_id is not null and vector is not null and size(vector) > 0")
        .filter(~bad & F.exists("vector", lambda x: x != 0))
    )


def pivot_table(classes: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Pivots of each dimension, unit length: distinct vectors with the smallest hashes, apart.

    A sample of MOST vectors at most, whatever the number of vectors.
    """
    count = int(min(MOST, max(FEWEST, n // VECTORS_PER_PIVOT)))
    rows = classes.orderBy(F.xxhash64("vector"), "vec_id").limit(count).select("vector").collect()
    by_size: dict[int, list[np.ndarray]] = {}
    for row in rows:
        by_size.setdefault(len(row[0]), []).append(unit(np.array([row[0]]))[0])
    return {size: _apart(np.array(found)) for size, found in by_size.items()}


def _apart(points: np.ndarray) -> np.ndarray:
    """The points in order, without those too close to one kept before."""
    near = points @ points.T >= APART
    kept: list[int] = []
    for i in range(len(points)):
        if not near[i, kept].any():
            kept.append(i)
    return points[kept]


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled by their largest component first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def postings(classes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """(size, pivot, prefix, vec_id, copies, vector): a row per vector and pivot of its prefix.

    Vectors of a size without pivots form one list of their size.
    """
    sent = classes.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.list_value_length(batch.column("vector")).to_numpy()
            for size in np.unique(sizes).tolist():
                rows = batch.filter(pa.array(sizes == size))
                for start in range(0, rows.num_rows, 2048):
                    part = rows.slice(start, 2048)
                    x = unit(_matrix(part.column("vector"), size))
                    points = sent.value.get(size)
                    if points is None:
                        near = np.full((len(x), 1), -1)
                    else:
                        k = min(PREFIX, len(points))
                        product = x @ points.T
                        near = np.argpartition(-product, k - 1, axis=1)[:, :k]
                        order = np.argsort(-np.take_along_axis(product, near, 1), axis=1, kind="stable")
                        near = np.take_along_axis(near, order, 1)
                    k = near.shape[1]
                    flat = pa.array(np.repeat(x, k, axis=0).ravel())
                    offsets = np.arange(len(x) * k + 1, dtype=np.int32)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(x) * k, size, dtype=np.int32)),
                        pa.array(near.ravel().astype(np.int32)),
                        pa.ListArray.from_arrays(offsets * k, pa.array(np.repeat(near, k, axis=0).ravel().astype(np.int32))),
                        pa.array(np.repeat(part.column("vec_id").to_numpy(), k)),
                        pa.array(np.repeat(part.column("copies").to_numpy(), k)),
                        pa.ListArray.from_arrays(offsets * size, flat),
                    ], ["size", "pivot", "prefix", "vec_id", "copies", "vector"])

    return classes.mapInArrow(
        run, "size int, pivot int, prefix array<int>, vec_id long, copies long, vector array<double>"
    )


def linked_in_list(
    pivot: int, prefix: np.ndarray, x: np.ndarray, other: np.ndarray | None, least: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of one list that share `least` pivots and reach the cosine.

    A pair that shares several pivots is reported in the list of the smallest of them only. With
    `other` (a chunk number per row), only pairs of different chunks are looked at.
    """
    for start in range(0, len(x), 256):
        rows = slice(start, start + 256)
        a = prefix[rows]
        shared = np.zeros((len(a), len(x)), dtype=np.int8)
        smaller = np.zeros((len(a), len(x)), dtype=bool)
        for k in range(a.shape[1]):
            match = (a[:, k, None, None] == prefix[None]).any(axis=2)
            shared += match
            smaller |= match & (a[:, k, None] < pivot)
        candidate = (shared >= least) & ~smaller
        candidate &= np.arange(len(x))[None] > np.arange(start, start + len(a))[:, None]
        if other is not None:
            candidate &= other[rows, None] != other[None]
        i, j = np.nonzero(candidate)
        if len(i):
            cosine = np.einsum("nd,nd->n", x[start + i], x[j])
            on = cosine >= COSINE
            yield start + i[on], j[on]


def _links(part: pa.Table) -> pa.Table:
    """Per vector of a list: how many copies its new links reach, and a tie to its neighbours.

    Only sums and one tie per vector leave the task, not the links; the ties connect whatever the
    links connect.
    """
    size = part.column("size")[0].as_py()
    ids, copies = part.column("vec_id").to_numpy(), part.column("copies").to_numpy()
    column = part.column("vector").combine_chunks()
    x = _matrix(column, size)
    prefix = part.column("prefix").combine_chunks()
    prefix = _matrix(prefix, len(prefix[0]))
    own = part.column("own").to_numpy()
    cut = part.column("i")[0].as_py() != part.column("j")[0].as_py()
    order = np.argsort(ids)
    ids, copies, x, prefix, own = ids[order], copies[order], x[order], prefix[order], own[order]
    reached = np.zeros(len(ids), dtype=np.int64)
    root = np.arange(len(ids))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    least = min(SHARED, prefix.shape[1])
    for i, j in linked_in_list(part.column("pivot")[0].as_py(), prefix, x, own if cut else None, least):
        np.add.at(reached, i, copies[j])
        np.add.at(reached, j, copies[i])
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            a, b = top(a), top(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    roots = np.array([top(i) for i in range(len(ids))], dtype=np.int64)
    on = reached > 0
    return pa.table({"vec_id": ids[on], "reached": reached[on], "tie": ids[roots[on]]})


def link_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of `vectors` (vec_id, embedding, any others).

    Vectors at a cosine of COSINE or more are linked; n_links counts the other rows linked
    directly, component_id is the smallest vec_id reachable, kept whether that is the row itself.

    Equal vectors form a class first and go on as one with their number of copies. The index is
    fitted on a bounded sample (see pivot_table), every vector is indexed. A list is cut into chunks
    of CHUNK postings that meet by twos, so no task holds a whole list. A pair is found unless it
    shares fewer than SHARED of its PREFIX nearest pivots; the README states the measured recall.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, and
    neither do vectors of different lengths. Rows with a null vec_id link with nothing, have a null
    component and are kept. Rows that share a vec_id and a vector count as copies of one another. An
    empty table gives no rows.
    """
    usable = usable_vectors(vectors)
    classes = stage(
        usable.groupBy("vector").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")),
        "vector_classes",
    )
    posted = postings(classes, pivot_table(classes, classes.count()))
    posted = stage(posted, "postings")
    lists = posted.groupBy("size", "pivot").agg(
        F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")
    )
    dealt = (
        posted.join(F.broadcast(lists), ["size", "pivot"])
        .withColumn("own", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
        .drop("other", "chunks")
    )
    found = stage(
        dealt.groupBy("size", "pivot", "i", "j").applyInArrow(_links, "vec_id long, reached long, tie long"),
        "vector_links",
    )
    ties = components(found.filter("tie <> vec_id").select(F.col("vec_id").alias("a"), F.col("tie").alias("b")))
    reached = found.groupBy("vec_id").agg(F.sum("reached").alias("reached"))
    named = (
        classes.withColumnRenamed("vec_id", "id")
        .join(reached.withColumnRenamed("vec_id", "id"), "id", "left")
        .join(ties.withColumnRenamed("node", "id"), "id", "left")
        .select("vector", (F.col("copies") - 1 + F.coalesce("reached", F.lit(0))).alias("n_links"),
                F.coalesce("component", "id").alias("component_id"))
    )
    members = usable.join(named, "vector").select("vec_id", "n_links", "component_id")
    members = members.groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    return (
        rows.join(members, "vec_id", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("component_id", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )


def op5_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES = {"op5_pivots": op5_pivots}
#: Cosines of all pairs are too slow in SQL on whole tables: the tests compare with all pairs.
ORACLES: dict[str, str] = {}
