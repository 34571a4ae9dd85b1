"""Near-duplicate documents: banded MinHash, sequential Bayesian pruning, exact verification.

Pairs that share a band are candidates. Their signatures are compared batch by batch; after each
batch a pair goes if, given the agreements so far, its similarity reaches the threshold with less
than the chosen miss probability. Survivors are verified on their full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import slices, table
from panelkit.llm.components import components
from panelkit.llm.shingles import mix, shingle_sets
from panelkit.storage import stage

#: A pair at similarity s shares no band with probability (1 - s ** ROWS) ** BANDS:
#: 3e-7 at 0.85 and 6e-5 at 0.8.
BANDS, ROWS = 32, 6
#: Signatures are compared in batches of so many values.
BATCH = 32
#: Values that the last comparison goes on to, so that few pairs below the threshold are left to
#: verify; only documents that share a band have so many.
LONG = 768
#: A pair is pruned once its chance of reaching the threshold is below this.
MISS = 1e-6
#: Bytes of text that a task works on at a time.
SLICE = 1 << 20
#: Members of a band that are compared with one another in one task; larger bands are cut.
CHUNK = 256

#: What tells sets of shingles apart.
SAME = ["n_shingles", "lo", "hi"]

_SIZE = BANDS * ROWS
_FACTORS = mix(np.arange(1, LONG + 1, dtype=np.uint64)) | np.uint64(1)
_BAND_MARKS = mix(np.arange(1000, 1000 + BANDS, dtype=np.uint64))
_ROW_MARKS = mix(np.arange(2000, 2000 + ROWS, dtype=np.uint64)) | np.uint64(1)


def minima(sets: list[np.ndarray], size: int) -> np.ndarray:
    """The least value of each set under `size` hash functions; no set is empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    least = np.empty((len(sets), size), dtype=np.uint64)
    for k in range(size):
        least[:, k] = np.minimum.reduceat(flat * _FACTORS[k], starts)
    return mix(least)


def marks_of(least: np.ndarray) -> np.ndarray:
    """One byte of each minimum: what signatures are compared by."""
    return (least & np.uint64(255)).astype(np.uint8)


def band_keys(least: np.ndarray) -> np.ndarray:
    """A key for each band: sets x BANDS."""
    rows = least[:, :_SIZE].reshape(len(least), BANDS, ROWS) * _ROW_MARKS
    return mix(rows.sum(axis=2, dtype=np.uint64) ^ _BAND_MARKS)


@lru_cache
def least_agreements(threshold: float, size: int, miss: float = MISS) -> tuple[tuple[int, int], ...]:
    """(values compared, agreements needed to go on) after each batch.

    The prior of the similarity is uniform; a byte agrees with probability s + (1 - s) / 256.
    """
    s = (np.arange(4000) + 0.5) / 4000
    agree = s + (1 - s) / 256
    needed = []
    for n in range(BATCH, size + 1, BATCH):
        for m in range(n + 1):
            log = m * np.log(agree) + (n - m) * np.log1p(-agree)
            weight = np.exp(log - log.max())
            if weight[s >= threshold].sum() / weight.sum() >= miss:
                needed.append((n, m))
                break
    return tuple(needed)


def surviving(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of two signature matrices are not pruned; each batch looks at survivors only."""
    alive, agreed = np.arange(len(a)), np.zeros(len(a), dtype=np.int32)
    for n, needed in least_agreements(threshold, a.shape[1]):
        part = slice(n - BATCH, n)
        agreed = agreed + (a[alive, part] == b[alive, part]).sum(axis=1, dtype=np.int32)
        on = agreed >= needed
        alive, agreed = alive[on], agreed[on]
    return alive


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, lo, hi, bands, signature) per row of `docs` (doc_id, text).

    lo and hi are sums over the set: equal for equal sets. Empty sets have null bands.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            sets = shingle_sets(batch.column("text").to_pylist())
            counts = np.array([len(s) for s in sets], dtype=np.int64)
            full = np.flatnonzero(counts)
            sums = np.zeros((2, len(sets)), dtype=np.uint64)
            bands: list = [None] * len(sets)
            marks: list = [None] * len(sets)
            if len(full):
                least = minima([sets[i] for i in full], _SIZE)
                keys, some = band_keys(least), marks_of(least)
                for row, i in enumerate(full.tolist()):
                    sums[0, i] = sets[i].sum(dtype=np.uint64)
                    sums[1, i] = mix(sets[i] + np.uint64(1)).sum(dtype=np.uint64)
                    bands[i], marks[i] = keys[row].view(np.int64), some[row].tobytes()
            lo, hi = sums.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(counts), pa.array(lo),
                 pa.array(hi), pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                ["doc_id", "text_key", "n_shingles", "lo", "hi", "bands", "signature"],
            )

    return _named(docs).select("doc_id", "text_key", "text").mapInArrow(
        run,
        "doc_id long, text_key string, n_shingles long, lo long, hi long, bands array<long>, signature binary",
    )


def _named(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, text): the two name a text even where ids repeat."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_key"), "text",
    )


def _ties(linkable: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): classes that one doc_id has texts in."""
    repeated = linkable.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    member = linkable.select("doc_id", *SAME).join(repeated, "doc_id", "left_semi").join(
        classes.select(*SAME, "id"), SAME
    ).select("doc_id", "id").distinct()
    least = member.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("most")).filter("a < most")
    return least.select("doc_id", "a").join(member, "doc_id").filter("a < id").select(
        "a", F.col("id").alias("b")
    ).distinct()


def _long_marks(texts: DataFrame) -> DataFrame:
    """(id, n_shingles, bands, signature) of LONG values; texts: (id, text), none without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            sets = shingle_sets(batch.column("text").to_pylist())
            least = minima(sets, LONG)
            found = [row.tobytes() for row in marks_of(least)]
            keys = list(band_keys(least).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(found, pa.binary())],
                ["id", "n_shingles", "bands", "signature"],
            )

    return texts.mapInArrow(run, "id long, n_shingles long, bands array<long>, signature binary")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union; texts: (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in slices(batches, "right", SLICE):
            ids = [batch.column(c).to_pylist() for c in ("a", "b")]
            wanted = dict.fromkeys(ids[0] + ids[1])
            known = {i: known[i] for i in wanted if i in known}
            new: dict[int, str] = {}
            for c, side in (("left", ids[0]), ("right", ids[1])):
                column = batch.column(c)
                for row, i in enumerate(side):
                    if i not in known and i not in new:
                        new[i] = column[row].as_py()
            known.update(zip(new, shingle_sets(list(new.values())), strict=True))
            on = []
            for row, (a, b) in enumerate(zip(*ids, strict=True)):
                x, y = known[a], known[b]
                if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * both >= percent * (len(x) + len(y) - both):
                        on.append(row)
            yield batch.select(["a", "b"]).take(pa.array(on, pa.int64()))

    return (
        pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("right")), "b")
        .join(texts.select(F.col("id").alias("a"), F.col("text").alias("left")), "a")
        .select("a", "b", "left", "right")
        .mapInArrow(run, "a long, b long")
    )


def _pairs_in_runs(run: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows with equal neighbouring values of `run`, by their distance."""
    ends = np.searchsorted(run, run, side="right")
    first = np.arange(len(run))
    for distance in range(1, len(run)):
        first = first[first + distance < ends[first]]
        if not len(first):
            return
        yield first, first + distance


def _first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first band whose key two rows of band keys share: by the keys that members meet by, as
    their bytes may also agree in an earlier band in which the two never meet.
    """
    return (a == b).argmax(axis=1)


def _best(a: np.ndarray, b: np.ndarray, agreed: np.ndarray) -> np.ndarray:
    """Which pairs are the best one of either of their members."""
    rows, pairs = np.concatenate([a, b]), np.tile(np.arange(len(a)), 2)
    order = np.lexsort([-agreed[pairs], rows])
    first = np.ones(len(order), dtype=bool)
    first[1:] = np.diff(rows[order]) != 0
    return np.unique(pairs[order[first]])


def _candidates(members: DataFrame, marks: DataFrame, percent: int, best: bool) -> DataFrame:
    """(a, b): pairs of band members in different components that survive their signatures.

    members: (key, band, id, component, chunks). Members of a band meet in one task, or in tasks of
    two chunks each if there are many, and a pair is only looked at further in the first band that the
    two share. Only what survives there leaves the task: with `best`, the pair of each member that
    agrees most, so that the pairs grow with the members and not with their squares; else every pair.
    """
    dealt = (
        members.join(marks, "id")
        .withColumn("own", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                "own", "band", "id", "component", "n_shingles", "signature", "bands")
        .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    )
    threshold = percent / 100

    def survivors(rows: pa.RecordBatch) -> pa.RecordBatch:
        key, i, j, own, band, ids, component, n = (rows.column(k).to_numpy() for k in range(8))
        marks = np.frombuffer(b"".join(rows.column(8).to_pylist()), np.uint8).reshape(len(key), -1)
        bands = rows.column(9).flatten().to_numpy().reshape(-1, BANDS)
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = (np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)
        found = [np.zeros((2, 0), dtype=np.int64)]
        for a, b in _pairs_in_runs(np.cumsum(fresh)):
            least, most = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
            on = (component[a] != component[b]) & (100 * least >= percent * most)
            on &= (i[a] == j[a]) | (own[a] != own[b])
            a, b = a[on], b[on]
            if len(a):
                on = _first_shared(bands[a], bands[b]) == band[a]
                a, b = a[on], b[on]
            on = surviving(marks[a], marks[b], threshold)
            a, b = a[on], b[on]
            found.append(np.stack([a, b]))
        a, b = np.concatenate(found, axis=1)
        if best and len(a):
            on = _best(a, b, (marks[a] == marks[b]).sum(axis=1))
            a, b = a[on], b[on]
        a, b = ids[a], ids[b]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.Table.from_batches([batch] if held is None else [held, batch])
            held = whole.combine_chunks().to_batches()[0]
            same = np.logical_and.reduce([
                held.column(k).to_numpy() == held.column(k)[held.num_rows - 1].as_py()
                for k in range(3)
            ])
            cut = int(np.argmax(same))
            if cut:
                yield survivors(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None:
            yield survivors(held)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _chunks(n: Column) -> Column:
    return F.ceil(n / CHUNK).cast("int").alias("chunks")


def _unfinished(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the bands that hold more than one component, with their components."""
    named = shared.drop("chunks").join(labels, "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    named = stage(named, "labelled_bands")
    bands = named.groupBy("key").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("n")
    ).filter("least < most").select("key", _chunks(F.col("n")))
    return named.join(bands, "key")


def link_documents(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of `docs` (doc_id, text, any others).

    Documents are linked if 100 * intersection >= percent * union of their five-word shingles (A-Z
    lower-cased). component_id is the smallest doc_id reachable by links, kept whether that is the
    document itself.

    Rows with equal sets form a class first and go on as one; only classes are compared, and the
    signature and text of a class are those of any member, as these are the same for its set. In each
    band every member is first tied to the member it agrees with most, which joins most of a large
    group in a number of pairs that grows with its size only. Then all members of a band whose
    components still differ are compared, so no link between components is left out. All candidates
    come from the bands, all pass the Bayesian comparison, and every link is verified on full sets.

    Texts that are null or without words have no shingles and link with nothing. Rows that share a
    doc_id are one document: what any of its texts links with is linked, in whatever order the rows
    come. Rows with a null doc_id link with nothing, have a null component_id and are kept. Very long
    texts are read whole, one at a time. An empty table gives no rows; other columns are not read.
    """
    sketched = stage(sketches(docs), "sketches")
    linkable = sketched.filter("n_shingles > 0 and doc_id is not null")
    classes = stage(
        linkable.groupBy(*SAME).agg(
            F.min(F.struct("doc_id", "text_key")).alias("first"),
            F.first("bands").alias("bands"), F.first("signature").alias("signature"),
        ).withColumn("id", F.monotonically_increasing_id()),
        "classes",
    )
    chosen = classes.select("id", "n_shingles", "bands", "signature")
    ties = stage(_ties(linkable, classes), "ties")
    keyed = chosen.select("id", F.posexplode("bands").alias("band", "key"))
    several = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = keyed.join(several.select("key", _chunks(F.col("n"))), "key")
    shared = stage(shared, "shared_bands")
    near = shared.select("id").distinct()
    marks = stage(
        chosen.join(near, "id", "left_semi").select("id", "n_shingles", "bands", "signature"),
        "signatures",
    )
    first = classes.join(near, "id", "left_semi").select("id", "first.doc_id", "first.text_key")
    texts = stage(
        _named(docs).join(first, ["doc_id", "text_key"]).select("id", "text").dropDuplicates(["id"]),
        "candidate_texts",
    )
    alone = shared.withColumn("component", F.col("id"))
    likely = stage(_candidates(alone, marks, percent, best=True), "best_pairs")
    links = stage(_verified(likely, texts, percent).unionByName(ties), "best_links")
    found = stage(components(links), "components").withColumnRenamed("node", "id")
    unfinished = stage(_unfinished(shared, found), "unfinished_bands")
    ids = unfinished.select("id").distinct()
    marks = stage(_long_marks(texts.join(ids, "id", "left_semi")), "long_signatures")
    others = stage(_candidates(unfinished, marks, percent, best=False), "open_pairs")
    more = stage(_verified(others, texts, percent), "open_links")
    if not more.isEmpty():
        found = components(links.unionByName(more)).withColumnRenamed("node", "id")
    labelled = classes.select(*SAME, "id", F.col("first.doc_id").alias("least")).join(
        found, "id", "left"
    ).withColumn("component", F.coalesce("component", "id"))
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    named = labelled.join(least, "component").select(*SAME, "component_id")
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return (
        sketched.select("doc_id", *SAME).join(named, SAME, "left")
        .select(
            "doc_id", "n_shingles",
            F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def without_near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One document of each group of `docs`, with all its columns.

    Of rows that share the doc_id of a kept document, the one whose columns hash lowest stays, in
    whatever order they come. Rows without doc_id all stay: they are linked with nothing.
    """
    kept = link_documents(docs, percent).filter("kept and doc_id is not null").select(
        F.col("doc_id").alias("_kept")
    ).distinct()
    named = docs.filter("doc_id is not null")
    columns = [named[c] for c in docs.columns]
    chosen = named.join(kept, named["doc_id"] == kept["_kept"], "left_semi").groupBy("doc_id").agg(
        F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("_row")
    )
    return chosen.select("_row.*").unionByName(docs.filter("doc_id is null"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), 85)


QUERIES = {"op9_minhash": op9_minhash}
#: Shingle sets of whole texts are too slow to join in SQL: the tests compare all pairs instead.
ORACLES: dict[str, str] = {}
