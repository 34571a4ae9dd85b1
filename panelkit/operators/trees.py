"""Tree ensembles as flat node arrays: predictions and Shapley values for whole batches of rows.

A task gets the arrays, a few bytes per node, and works on an Arrow batch at a time. Shapley values
are path-dependent (Lundberg et al. 2018). For one leaf they are the integral over t in [0, 1] of the
product of (1 - t) * cover + t * agreement over the path's other features, a polynomial of a degree
below the number of these features, so a Gauss-Legendre rule of half as many points is exact. Work is
in proportion to leaves times depth, with no table over the patterns of agreement.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Values of (rows x leaves x path features) that a task holds at a time; they stay near the processor.
CELLS = 1 << 16


@dataclass(frozen=True, eq=False)
class TreeEnsemble:
    """Nodes of all trees, one after another. Rows with x <= threshold go left; leaves are their own
    children. `value` is what a leaf adds, `cover` the training weight of a node."""

    tree: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray
    base: float = 0.0
    link: str = "identity"

    @cached_property
    def roots(self) -> np.ndarray:
        return np.flatnonzero(np.diff(self.tree, prepend=-1))

    @cached_property
    def is_leaf(self) -> np.ndarray:
        return self.left == np.arange(len(self.left))

    @cached_property
    def depth(self) -> int:
        depth, at = 0, self.roots
        while True:
            at = at[~self.is_leaf[at]]
            if not len(at):
                return depth
            at = np.concatenate([self.left[at], self.right[at]])
            depth += 1

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Sum of the trees for each row, before the link."""
        out, rows = np.full(len(x), self.base), np.arange(len(x))[:, None]
        step = max(1, CELLS // max(len(x), 1))
        for start in range(0, len(self.roots), step):
            at = np.repeat(self.roots[None, start:start + step], len(x), axis=0)
            for _ in range(self.depth):
                goes_left = x[rows, self.feature[at]] <= self.threshold[at]
                at = np.where(goes_left, self.left[at], self.right[at])
            out += self.value[at].sum(axis=1)
        return out

    def predictions(self, x: np.ndarray) -> np.ndarray:
        return np.exp(self.margins(x)) if self.link == "log" else self.margins(x)

    def first(self, trees: int) -> TreeEnsemble:
        """The ensemble of the first trees only."""
        kept = self.tree < trees
        arrays = {f.name: getattr(self, f.name) for f in fields(self)}
        return TreeEnsemble(**{k: v[kept] if isinstance(v, np.ndarray) else v for k, v in arrays.items()})

    def importances(self, features: int) -> np.ndarray:
        """Total gain of the splits on each feature, as parts of one."""
        inner = ~self.is_leaf
        total = np.bincount(self.feature[inner], weights=self.gain[inner], minlength=features)
        return total / (total.sum() or 1.0)

    @cached_property
    def paths(self) -> list[Paths]:
        return [self._paths(root) for root in self.roots]

    def _paths(self, root: int) -> Paths:
        found, stack = [], [(int(root), {})]
        while stack:
            node, path = stack.pop()
            if self.is_leaf[node]:
                found.append((self.value[node], path))
                continue
            f, cut = int(self.feature[node]), self.threshold[node]
            low, high, cover = path.get(f, (-np.inf, np.inf, 1.0))
            for child, bounds in (
                (int(self.left[node]), (low, min(high, cut))), (int(self.right[node]), (max(low, cut), high)),
            ):
                part = self.cover[child] / self.cover[node]
                # A side that no training row went to has no weight in any average.
                stack.append((child, {**path, f: (*bounds, cover * part)}))
        return Paths.of(found)

    @property
    def expected(self) -> float:
        """The average of the trees over the training rows: what contributions are measured from."""
        leaf = self.is_leaf
        part = self.cover[leaf] / self.cover[self.roots][self.tree[leaf] - self.tree[0]]
        return self.base + float((self.value[leaf] * part).sum())

    def contributions(self, x: np.ndarray) -> np.ndarray:
        """Shapley value of every feature for each row: with `expected` they add up to the margin."""
        out = np.zeros_like(x)
        # Missing values go right, so they are above every cut; the least value is above no end.
        x = np.nan_to_num(x, nan=np.inf, posinf=np.inf, neginf=np.finfo(float).min)
        for paths in self.paths:
            rows = max(1, CELLS // max(paths.cover.size, 1))
            for start in range(0, len(x), rows):
                paths.add_contributions(x[start:start + rows], out[start:start + rows])
        return out


@dataclass(frozen=True, eq=False)
class Paths:
    """The leaves of one tree: per leaf and path feature the interval and the part of cover that
    passes. Short paths are filled up with a feature that everything agrees with."""

    value: np.ndarray
    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    cover: np.ndarray

    @staticmethod
    def of(leaves: Sequence[tuple[float, dict]]) -> Paths:
        width = max([len(path) for _, path in leaves] + [1])
        shape = (len(leaves), width)
        feature, cover = np.zeros(shape, np.int64), np.ones(shape)
        low, high = np.full(shape, -np.inf), np.full(shape, np.inf)
        for i, (_, path) in enumerate(leaves):
            for j, (f, (a, b, part)) in enumerate(path.items()):
                feature[i, j], low[i, j], high[i, j], cover[i, j] = f, a, b, part
        return Paths(np.array([v for v, _ in leaves]), feature, low, high, cover)

    @cached_property
    def rule(self) -> tuple[np.ndarray, ...]:
        """What every batch needs, from Gauss-Legendre points on [0, 1] that are exact for the
        product of all path features but one: per leaf the logarithms of that product for no
        agreement and of the ratio that each agreement brings, and the factors of the shares of a
        feature that agrees and of one that does not; also the order of the columns by feature."""
        t, weight = np.polynomial.legendre.leggauss((self.cover.shape[1] + 1) // 2)
        t, weight = (t + 1) / 2, weight / 2
        apart = (1 - t) * self.cover[:, :, None]
        agreed = apart + t
        order = np.argsort(self.feature.ravel(), kind="stable")
        columns, first = np.unique(self.feature.ravel()[order], return_index=True)
        return (
            np.log(apart).sum(axis=1)[:, :, None], np.log(agreed / apart).transpose(0, 2, 1),
            weight[None, :, None] * self.value[:, None, None],
            (1 - self.cover)[:, :, None] / agreed, -self.cover[:, :, None] / apart, order, columns, first,
        )

    def add_contributions(self, x: np.ndarray, out: np.ndarray) -> None:
        none, ratio, weight, agreed, apart, order, columns, first = self.rule
        values = x[:, self.feature.ravel()].T.reshape(*self.feature.shape, len(x))
        agrees = ((values > self.low[:, :, None]) & (values <= self.high[:, :, None])).astype(float)
        whole = np.exp(np.matmul(ratio, agrees) + none) * weight
        if_not = np.matmul(apart, whole)
        shares = if_not + agrees * (np.matmul(agreed, whole) - if_not)
        out[:, columns] += np.add.reduceat(shares.reshape(-1, len(x))[order], first, axis=0).T


def matrix(batch: pd.DataFrame) -> np.ndarray:
    return np.ascontiguousarray(batch.to_numpy(dtype=float, na_value=np.nan))


def predicted(trees: TreeEnsemble, features: Sequence[str]) -> Column:
    """The prediction for the row's features, whole Arrow batches at a time."""

    @F.pandas_udf("double")
    def predict(batch: pd.DataFrame) -> pd.Series:
        return pd.Series(trees.predictions(matrix(batch)))

    return predict(F.struct(*[F.col(f).cast("double") for f in features]))


def save(trees: TreeEnsemble, path: str) -> None:
    """One row per node, and the base and link in each."""
    spark = SparkSession.getActiveSession()
    nodes = pd.DataFrame({f.name: getattr(trees, f.name) for f in fields(trees)})
    spark.createDataFrame(nodes.assign(node=range(len(nodes)))).write.mode("overwrite").parquet(path)


def load(path: str) -> TreeEnsemble:
    nodes = SparkSession.getActiveSession().read.parquet(path).toPandas().sort_values("node")
    arrays = {f.name: nodes[f.name].to_numpy() for f in fields(TreeEnsemble)}
    arrays["base"], arrays["link"] = float(arrays["base"][0]), str(arrays["link"][0])
    return TreeEnsemble(**arrays)


def from_nodes(stored: DataFrame, scale: Sequence[float]) -> TreeEnsemble:
    """The ensemble of a saved Spark model: one row per node, ids in order within a tree."""
    nodes = stored.select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild",
        F.col("nodeData.rawCount").cast("double").alias("cover"), "nodeData.gain",
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    ).toPandas().sort_values(["treeID", "id"])
    tree = nodes["treeID"].to_numpy()
    first = np.searchsorted(tree, tree)
    at, left, right = np.arange(len(tree)), nodes["leftChild"].to_numpy(), nodes["rightChild"].to_numpy()
    leaf = left < 0
    return TreeEnsemble(
        tree=tree, feature=np.maximum(nodes["feature"].to_numpy(), 0).astype(np.int64),
        threshold=np.where(leaf, np.inf, nodes["threshold"].to_numpy(dtype=float, na_value=np.inf)),
        left=np.where(leaf, at, first + left), right=np.where(leaf, at, first + right),
        value=nodes["prediction"].to_numpy() * np.asarray(scale)[tree],
        cover=nodes["cover"].to_numpy(), gain=np.maximum(nodes["gain"].to_numpy(), 0.0) * nodes["cover"].to_numpy(),
    )
