"""Quality classifier from positive and unlabelled documents, by non-negative unbiased risk.

Trusted documents are labelled; of the web texts beside them nothing is known but an estimated share
of good ones. A small network on counts of a text's characters, words and lines is trained on a
bounded sample and then scores every document where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.common import remainder, slices, table

#: Documents the model is trained on, at most: those with the smallest hashes.
POSITIVE_ROWS, UNLABELLED_ROWS = 12_000, 24_000
HIDDEN, STEPS, RATE, DECAY = 24, 400, 0.02, 1e-3
SEED = 7
#: Least share of trusted documents above a cut that the class prior is read from.
LEAST_TAIL = 0.5
#: A document is predicted good from this score on.
CUT = 0.7

_LETTERS = [*range(65, 91), *range(97, 123)]
_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58),
    "beyond": range(128, 256), "blank": [9, 11, 12, 13, 32], "line": [10],
    **{f"sign{c}": [c] for c in range(33, 127) if c not in _LETTERS and not 48 <= c < 58},
}
_MEMBERS = np.zeros((256, len(_CLASSES)))
for _k, _bytes in enumerate(_CLASSES.values()):
    _MEMBERS[list(_bytes), _k] = 1.0
FEATURES = len(_CLASSES) + 8


def features(text: str | None) -> np.ndarray:
    """Shares of character classes, and how words and lines are sized and repeat. Any text has them."""
    raw = (text or "").encode()
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256) @ _MEMBERS
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n, m = max(len(words), 1), max(len(lines), 1)
    neighbours = sum(map(bytes.__eq__, words[1:], words))
    shape = [
        np.log1p(len(words)), np.log1p(len(raw) / n), len(set(words)) / n,
        len(set(words)) / n**0.8, neighbours / n, 1 - len(set(lines)) / m, np.log1p(n / m),
        len(max(words, key=len, default=b"")) / (20 + len(raw) / n),
    ]
    return np.concatenate([np.sqrt(counts / max(len(raw), 1)), shape])


class Model(NamedTuple):
    """A network with one hidden layer; None for weights where nothing could be learned."""

    mean: np.ndarray
    scale: np.ndarray
    weights: tuple[np.ndarray, np.ndarray, np.ndarray, float] | None
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return _sigmoid(_forward(self.weights, z)[0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _forward(weights, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b, c, d = weights
    hidden = np.tanh(z @ a + b)
    return hidden @ c + d, hidden


def _train(p: np.ndarray, u: np.ndarray, prior: float, weight_p: float, non_negative: bool):
    """Adam on the risk of positives `p` and unlabelled `u` (standardised features).

    non_negative: prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) with the logistic loss. Where the
    part in the maximum is negative, its gradient is taken backwards. Else the plain risk of telling
    `p` from `u`, with `weight_p` on the first.
    """
    rng = np.random.default_rng(SEED)
    params = [rng.normal(0, 1 / np.sqrt(p.shape[1]), (p.shape[1], HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    first, second = ([np.zeros_like(x) for x in params] for _ in range(2))
    both = np.vstack([p, u])
    n = len(p)
    for step in range(1, STEPS + 1):
        out, hidden = _forward((*params[:3], params[3][0]), both)
        s = _sigmoid(out)
        up = np.zeros(len(both))
        if non_negative:
            # Derivatives of log(1 + exp(-out)) and log(1 + exp(out)) are s - 1 and s.
            rest = np.logaddexp(0, out[n:]).mean() - prior * np.logaddexp(0, out[:n]).mean()
            if rest >= 0:
                up[:n] = prior * (s[:n] - 1) / n - prior * s[:n] / n
                up[n:] = s[n:] / len(u)
            else:
                up[:n] = prior * s[:n] / n
                up[n:] = -s[n:] / len(u)
        else:
            up[:n] = weight_p * (s[:n] - 1) / n
            up[n:] = (1 - weight_p) * s[n:] / len(u)
        back = (up[:, None] * params[2]) * (1 - hidden**2)
        grads = [both.T @ back, back.sum(0), hidden.T @ up, np.array([up.sum()])]
        for k, g in enumerate(grads):
            g = g + DECAY * params[k] * (k in (0, 2))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            params[k] = params[k] - RATE * (first[k] / (1 - 0.9**step)) / (
                np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
            )
    return params[0], params[1], params[2], float(params[3][0])


def class_prior(p: np.ndarray, u: np.ndarray) -> float:
    """Share of good documents among the unlabelled, from scores that tell `p` from `u`.

    Above any cut the unlabelled hold at least the share's part of what the trusted hold there; the
    smallest quotient over the cuts is the estimate.
    """
    cuts = np.quantile(p, np.linspace(0.0, 1 - LEAST_TAIL, 50))
    tail_p = 1 - np.searchsorted(np.sort(p), cuts) / len(p)
    tail_u = 1 - np.searchsorted(np.sort(u), cuts) / len(u)
    return float(np.clip((tail_u / tail_p).min(), 0.02, 0.98))


def fit(p: np.ndarray, u: np.ndarray) -> Model:
    """A model from features of trusted and of unlabelled documents.

    Every other document of either kind trains the first classifier, the rest estimates the prior.
    """
    if len(p) < 4 or len(u) < 4:
        return Model(np.zeros(FEATURES), np.ones(FEATURES), None, 0.5)
    mean, scale = u.mean(0), u.std(0) + 1e-3
    zp, zu = (np.clip((x - mean) / scale, -8, 8) for x in (p, u))
    first = _train(zp[::2], zu[::2], 0.5, 0.5, non_negative=False)
    prior = class_prior(_forward(first, zp[1::2])[0], _forward(first, zu[1::2])[0])
    return Model(mean, scale, _train(zp, zu, prior, 0.5, non_negative=True), prior)


def _may_learn(doc_id: Column) -> Column:
    return remainder(doc_id, 4) != 2


def _feature_rows(texts: DataFrame) -> np.ndarray:
    """The features of a bounded table's texts, collected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = np.stack([features(t) for t in batch.column("text").to_pylist()])
            flat = pa.array(x.astype(np.float32).ravel())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.FixedSizeListArray.from_arrays(flat, FEATURES).cast(pa.list_(pa.float32()))],
                ["doc_id", "x"],
            )

    schema = T.StructType([texts.schema["doc_id"], T.StructField("x", T.ArrayType(T.FloatType()))])
    rows = texts.select("doc_id", "text").mapInArrow(run, schema).orderBy(F.xxhash64("doc_id"), "doc_id", "x")
    got = rows.select("x").toArrow().column("x").combine_chunks()
    return got.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, FEATURES)


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from documents whose ids may be learned from: crc32(doc_id) mod 4 is not 2.

    Positives are labelled good; labels of bad documents are never looked at. The unlabelled are a
    hashed sample of all documents. Both samples are bounded, and only their features are collected.
    """
    good = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull() & _may_learn(F.col("doc_id")))
    draw = [F.xxhash64("doc_id"), F.col("doc_id")]
    positive = good.select("doc_id").distinct().orderBy(*draw).limit(POSITIVE_ROWS)
    usable = docs.filter(F.col("doc_id").isNotNull() & _may_learn(F.col("doc_id")))
    sample = usable.select("doc_id").distinct().orderBy(*draw).limit(UNLABELLED_ROWS)
    wanted = positive.select("doc_id", F.lit(1).alias("p"), F.lit(0).alias("u")).unionByName(
        sample.select("doc_id", F.lit(0).alias("p"), F.lit(1).alias("u"))
    ).groupBy("doc_id").agg(F.max("p").alias("p"), F.max("u").alias("u"))
    texts = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").cache()
    try:
        p, u = (_feature_rows(texts.filter(f"{kind} = 1")) for kind in ("p", "u"))
    finally:
        texts.unpersist()
    return fit(p, u)


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted): score from 0 to 1 of each whole text, predicted 1 from CUT on.

    Null texts count as empty and are scored like any other; so are null ids and repeated rows. An
    empty table gives no rows; with too few rows to learn from, every score is 0.5. Other columns
    are not read, nothing is shuffled, and the model has a fixed size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            scores = model.scores(np.stack([features(t) for t in batch.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores), pa.array((scores >= CUT).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    fields = [docs.schema["doc_id"], T.StructField("score", T.DoubleType()),
              T.StructField("predicted", T.IntegerType())]
    return docs.select("doc_id", "text").mapInArrow(run, T.StructType(fields))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, learn(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", (~_may_learn(F.col("doc_id"))).alias("held_out"), "score", "predicted"
    )


QUERIES = {"op10_quality": op10_quality}
#: A trained model is not expressible in SQL: the tests measure held-out accuracy.
ORACLES: dict[str, str] = {}
