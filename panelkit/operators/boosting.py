"""Gradient boosting with the Tweedie loss and a log link, one Spark job per round.

Features are binned once and kept as columns of bytes in chunks of rows. The shape of a tree, its
splits, is searched in histograms of a bounded sample of training rows; everything that is estimated
then comes from all rows: each round is one pass that routes every row through the new tree, sums
gradient and hessian per leaf for its Newton step, and sums the loss on training and validation rows.
The next tree's shape is searched while that pass runs. With validation rows the fit stops `patience`
rounds after the best one, and the ensemble is cut to its best length; nothing is fitted twice.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.trees import TreeEnsemble, matrix
from panelkit.storage import stage

#: Rows whose histograms decide on splits. More training rows are thinned by a hash of their values.
SHAPE_ROWS = 100_000
BINS = 64
#: Rounds between two refreshes of the kept scores.
KEPT_ROUNDS = 25


@dataclass(frozen=True)
class Tweedie:
    """Half the deviance, up to a constant of the data, as a function of the log of the prediction."""

    power: float = 1.1

    def derivatives(self, y: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = y * np.exp((1 - self.power) * s), np.exp((2 - self.power) * s)
        return b - a, (self.power - 1) * a + (2 - self.power) * b

    def loss(self, y: np.ndarray, s: np.ndarray) -> np.ndarray:
        return y * np.exp((1 - self.power) * s) / (self.power - 1) + np.exp((2 - self.power) * s) / (2 - self.power)


@dataclass
class Tree:
    """A tree over bins; rows with bin <= cut go left, leaves are their own children."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    gain: np.ndarray
    depth: int
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    cover: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row; `bins` has a line per feature."""
        at, rows = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
        for _ in range(self.depth):
            at = np.where(bins[self.feature[at], rows] <= self.cut[at], self.left[at], self.right[at])
        return at


def grow(
    bins: np.ndarray, g: np.ndarray, h: np.ndarray, features: np.ndarray, depth: int,
    penalty: float = 1.0, least: float = 1.0,
) -> Tree:
    """The tree of the best splits by second-order gain, level by level.

    Of two children only the smaller is counted; the other's histogram is the difference.
    """
    at = np.zeros(len(g), np.int64)
    feature, cut, left, right, gain = [0], [BINS], [0], [0], [0.0]
    level = [0]

    def counted(rows: np.ndarray, slots: np.ndarray, n: int) -> np.ndarray:
        out = np.empty((2, len(features), n * BINS))
        base, g_rows, h_rows = slots * BINS, g[rows], h[rows]
        for j, f in enumerate(features):
            key = base + bins[f][rows]
            out[0, j] = np.bincount(key, weights=g_rows, minlength=n * BINS)
            out[1, j] = np.bincount(key, weights=h_rows, minlength=n * BINS)
        return out.reshape(2, len(features), n, BINS).transpose(2, 0, 1, 3)

    sums = counted(np.arange(len(g)), at, 1)
    for deep in range(depth):
        gl, hl = np.cumsum(sums, axis=3).transpose(1, 0, 2, 3)
        ga, ha = gl[:, :, -1:], hl[:, :, -1:]
        gr, hr = ga - gl, ha - hl
        score = gl**2 / (hl + penalty) + gr**2 / (hr + penalty) - ga**2 / (ha + penalty)
        score = np.where((hl >= least) & (hr >= least), score, 0.0)
        best = score.reshape(len(level), -1).argmax(axis=1)
        chosen, bin_cut = np.divmod(best, BINS)
        won = score.reshape(len(level), -1)[np.arange(len(level)), best]
        slot = np.full(len(feature), -1)
        parents, next_level = [], []
        for i, node in enumerate(level):
            if won[i] <= 1e-9:
                continue
            feature[node], cut[node], gain[node] = int(features[chosen[i]]), int(bin_cut[i]), float(won[i])
            left[node], right[node] = len(feature), len(feature) + 1
            for _ in range(2):
                next_level.append(len(feature))
                left.append(len(feature))
                right.append(len(feature))
                feature.append(0)
                cut.append(BINS)
                gain.append(0.0)
            parents.append(i)
        if not parents:
            break
        f, c, lo, hi = map(np.array, (feature, cut, left, right))
        moves = np.where(bins[f[at], np.arange(len(at))] <= c[at], lo[at], hi[at])
        at = moves
        if deep + 1 == depth:
            break
        counts = np.bincount(at, minlength=len(feature))
        small = [n if counts[n] <= counts[n + 1] else n + 1 for n in next_level[::2]]
        slot = np.full(len(feature), -1)
        slot[small] = np.arange(len(small))
        rows = np.flatnonzero(slot[at] >= 0)
        fewer = counted(rows, slot[at[rows]], len(small))
        both = np.empty((len(next_level), *sums.shape[1:]))
        for k, (parent, one) in enumerate(zip(parents, small, strict=True)):
            mine = one - next_level[2 * k]
            both[2 * k + mine], both[2 * k + 1 - mine] = fewer[k], sums[parent] - fewer[k]
        sums, level = both, next_level
    return Tree(*map(np.array, (feature, cut, left, right, gain)), depth=depth)


def bin_edges(train: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    """Up to 63 cuts per feature, from quantiles of all training rows."""
    parts = [i / BINS for i in range(1, BINS)]
    row = train.agg(*[
        F.percentile_approx(F.col(f).cast("double"), parts, 1000).alias(f"q{i}") for i, f in enumerate(features)
    ]).first()
    return [np.unique(np.array(q or [], dtype=float)) for q in row]


def _binned(rows: DataFrame, edges: list[np.ndarray], features: Sequence[str], label: str) -> DataFrame:
    """Chunks of rows: bins of one byte per value, label, and whether the row is held out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = matrix(batch[list(features)])
            bins = np.stack([np.searchsorted(e, x[:, j]).astype(np.uint8) for j, e in enumerate(edges)])
            yield pd.DataFrame({
                "rows": [len(batch)], "bins": [bins.tobytes()],
                "label": [batch["_label"].to_numpy(dtype=float).tobytes()],
                "held_out": [batch["_held_out"].to_numpy(dtype=np.uint8).tobytes()],
            })

    return rows.select(
        *[F.col(f).cast("double").alias(f) for f in features],
        F.col(label).cast("double").alias("_label"), "_held_out",
    ).mapInPandas(run, "rows int, bins binary, label binary, held_out binary")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for row in batch.to_pylist():
            n = row["rows"]
            score = np.frombuffer(row["score"]) if row.get("score") else None
            yield (np.frombuffer(row["bins"], np.uint8).reshape(-1, n), np.frombuffer(row["label"]),
                   np.frombuffer(row["held_out"], np.uint8).astype(bool), score)


def _with_scores(chunks: DataFrame, base: float, trees: list[Tree]) -> DataFrame:
    """The chunks with the scores of all trees so far, kept by the executors; they can be made again
    from the written chunks at any time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (bins, y, _, _) in enumerate(_chunks([batch])):
                score = np.full(len(y), base)
                for tree in trees:
                    score += tree.value[tree.leaves(bins)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(i, 1).columns, pa.array([score.tobytes()], pa.binary())],
                    [*batch.schema.names, "score"],
                )

    schema = "rows int, bins binary, label binary, held_out binary, score binary"
    return chunks.mapInArrow(run, schema).persist(StorageLevel.MEMORY_AND_DISK)


def _pass(chunks: DataFrame, recent: list[Tree], tree: Tree | None, loss: Tweedie) -> tuple[np.ndarray, np.ndarray]:
    """Per leaf of `tree` the sums of gradient, hessian and rows; and loss and rows of both sides.

    Tasks add up; a task sends a few numbers per leaf.
    """
    leaves = len(tree.feature) if tree else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, losses = np.zeros((3, leaves)), np.zeros(4)
        for bins, y, held_out, score in _chunks(batches):
            score = score.copy()
            for one in recent:
                score += one.value[one.leaves(bins)]
            each, train = loss.loss(y, score), ~held_out
            losses += [each[train].sum(), train.sum(), each[held_out].sum(), held_out.sum()]
            if tree:
                at = tree.leaves(bins)[train]
                g, h = loss.derivatives(y[train], score[train])
                sums += [np.bincount(at, weights=w, minlength=leaves) for w in (g, h, np.ones(len(at)))]
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes() + losses.tobytes()], pa.binary())], ["sums"])

    total = np.zeros(3 * leaves + 4)
    for row in chunks.mapInArrow(run, "sums binary").collect():
        total += np.frombuffer(row["sums"])
    return total[:-4].reshape(3, leaves), total[-4:]


def _node_cover(tree: Tree, leaf_rows: np.ndarray) -> np.ndarray:
    cover = leaf_rows.copy()
    for node in range(len(cover) - 1, -1, -1):
        if tree.left[node] != node:
            cover[node] = cover[tree.left[node]] + cover[tree.right[node]]
    return cover


@dataclass
class Boosted:
    """The ensemble with the mean losses before each round, and after the last one."""

    trees: TreeEnsemble
    rounds: int
    best_round: int
    train_loss: list[float]
    validation_loss: list[float]


def fit(
    train: DataFrame,
    validation: DataFrame | None,
    features: Sequence[str],
    label: str,
    rounds: int,
    patience: int,
    depth: int,
    step: float,
    fraction: float = 0.8,
    loss: Tweedie | None = None,
    penalty: float = 1.0,
    seed: int = 0,
    shape_rows: int = SHAPE_ROWS,
) -> Boosted:
    """Fit up to `rounds` trees. Labels are never negative.

    `fraction` of the sampled rows and of the features are looked at for the shape of each tree.
    """
    loss = loss or Tweedie()
    edges = bin_edges(train, features)
    rows = train.withColumn("_held_out", F.lit(False))
    if validation is not None:
        same = [*features, label]
        rows = rows.select(*same, "_held_out").unionByName(
            validation.select(*same).withColumn("_held_out", F.lit(True))
        )
    chunks = stage(_binned(rows, edges, features, label), "binned_rows")
    n, total = train.agg(F.count("*"), F.sum(F.col(label).cast("double"))).first()
    if not n:
        raise ValueError("no training rows")
    base = float(np.log(max(total / n, 1e-6)))
    # Rows are thinned by a hash of their values, the same rows in every run.
    part = F.pmod(F.xxhash64(F.lit(seed), *features), F.lit(1 << 20)) < int(min(1.0, shape_rows / n) * (1 << 20))
    sample = list(_chunks(
        pa.RecordBatch.from_pylist([r.asDict()]) for r in _binned(
            train.filter(part).withColumn("_held_out", F.lit(False)), edges, features, label
        ).toLocalIterator()
    ))
    x = np.concatenate([c[0] for c in sample], axis=1) if sample else np.zeros((len(features), 0), np.uint8)
    y = np.concatenate([c[1] for c in sample]) if sample else np.zeros(0)
    draw = np.random.default_rng(seed)
    used = max(1, round(fraction * len(features)))

    def shape(score: np.ndarray) -> Tree:
        some = np.flatnonzero(draw.random(len(y)) < fraction) if len(y) > 1000 else np.arange(len(y))
        columns = np.sort(draw.choice(len(features), used, replace=False))
        g, h = loss.derivatives(y[some], score[some])
        return grow(np.ascontiguousarray(x[:, some]), g, h, columns, depth, penalty)

    def steps(sums: np.ndarray) -> np.ndarray:
        return -step * sums[0] / (sums[1] + penalty)

    trees, train_loss, held_loss, best = [], [], [], 0
    kept, recent, score = _with_scores(chunks, base, []), [], np.full(len(y), base)
    tree = shape(score)
    with ThreadPoolExecutor(1) as pool:
        while True:
            last = len(trees) == rounds
            job = pool.submit(_pass, kept, list(recent), None if last else tree, loss)
            if not last:
                # Until all rows have answered, the sample's own steps stand in for the next shape.
                at = tree.leaves(x)
                g, h = loss.derivatives(y, score)
                own = steps(np.stack([np.bincount(at, weights=w, minlength=len(tree.feature)) for w in (g, h)]))
                following = shape(score + own[at])
            sums, losses = job.result()
            train_loss.append(float(losses[0] / losses[1]))
            held_loss.append(float(losses[2] / losses[3]) if losses[3] else float("nan"))
            if held_loss[-1] < held_loss[best]:
                best = len(held_loss) - 1
            if last or (losses[3] and len(trees) - best >= patience):
                break
            tree.value, tree.cover = steps(sums), _node_cover(tree, sums[2])
            trees.append(tree)
            recent.append(tree)
            score += tree.value[at]
            tree = following
            if len(recent) == KEPT_ROUNDS:
                older = kept
                kept, recent = _with_scores(chunks, base, trees), []
                older.unpersist()
    kept.unpersist()
    fitted = len(trees)
    chosen = best if validation is not None and losses[3] else fitted
    return Boosted(_ensemble(trees[:max(chosen, 1)], edges, base), fitted, max(chosen, 1), train_loss, held_loss)


def _ensemble(trees: list[Tree], edges: list[np.ndarray], base: float) -> TreeEnsemble:
    start = np.cumsum([0] + [len(t.feature) for t in trees])
    cuts = np.full((len(edges), BINS + 1), np.inf)
    for f, e in enumerate(edges):
        cuts[f, :len(e)] = e
    join = np.concatenate
    return TreeEnsemble(
        tree=join([np.full(len(t.feature), i) for i, t in enumerate(trees)]),
        feature=join([t.feature for t in trees]),
        threshold=join([cuts[t.feature, t.cut] for t in trees]),
        left=join([t.left + s for t, s in zip(trees, start)]),
        right=join([t.right + s for t, s in zip(trees, start)]),
        value=join([t.value for t in trees]), cover=join([t.cover for t in trees]),
        gain=join([t.gain for t in trees]), base=base, link="log",
    )
