"""Toxicity: a weighted lexicon matched by Aho-Corasick in folded text, normalised by length.

The lexicon is learned: word beginnings that labelled toxic documents have far more often than
labelled clean ones, weighted by their log odds.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.common import remainder, slices, table

#: Labelled documents that the lexicon is learned from, at most: those with the smallest hashes.
TOXIC_ROWS, CLEAN_ROWS = 5_000, 10_000
#: Word beginnings that are counted in clean documents, at most: those in most toxic documents.
CANDIDATES = 50_000
#: Lengths of the word beginnings, and the documents an entry must be in.
SHORTEST, LONGEST, LEAST_DOCUMENTS = 4, 10, 3
#: Least log odds of an entry, and how far its likelihood ratio statistic must pass what the best of
#: as many meaningless candidates would reach.
LEAST_WEIGHT, MARGIN = 1.5, 6.0
#: Entries after which a toxic document needs no further one.
EXPLAINED = 2
#: Phrases in which an entry does not count.
EXCEPTIONS = ("trash can", "trash bin", "class clown", "clown fish", "sore loser rule")

#: Letters that look like Latin ones, and digits or signs used in place of letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d",
    "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ɑ": "a",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
#: Characters without width that are put between letters.
INVISIBLE = "­​‌‍⁠﻿"
WORD = re.compile(r"[^\W_]+")


def _folding() -> dict[int, str | None]:
    """Look-alikes, substitutes, full-width and mathematical letters to plain ones.

    Accents stay: in several languages they tell words apart.
    """
    table: dict[int, str | None] = {}
    spans = (range(0xFF01, 0xFF5F), range(0x1D400, 0x1D800))
    for code in (c for span in spans for c in span):
        plain = unicodedata.normalize("NFKD", chr(code))
        base = "".join(c for c in plain if not unicodedata.combining(c)).lower()
        if base and base.isascii():
            table[code] = base
    table |= {ord(c): to for c, to in (HOMOGLYPHS | DIGITS).items()}
    table |= {ord(c.upper()): to for c, to in HOMOGLYPHS.items() if len(c.upper()) == 1 and c.upper() != to.upper()}
    table |= {code: None for code in (*map(ord, INVISIBLE), *range(0x300, 0x370))}
    return table


FOLDING = _folding()


def fold(text: str | None) -> str:
    return (text or "").lower().translate(FOLDING)


class Lexicon(NamedTuple):
    """Entries with their weights, phrases that suspend them, and the curve of the score."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    bias: float = -2.0
    slope: float = 1.0


class Matcher:
    def __init__(self, lexicon: Lexicon):
        self.automaton = ahocorasick.Automaton()
        for phrase in map(fold, lexicon.exceptions):
            self.automaton.add_word(phrase, (len(phrase), 0.0))
        for entry, weight in lexicon.weights.items():
            self.automaton.add_word(entry, (len(entry), weight))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()
        self.lexicon = lexicon

    def features(self, text: str | None) -> tuple[float, int]:
        """Sum of weights over matches at word beginnings outside exception phrases, and words."""
        folded = fold(text)
        words = len(folded.split())
        if self.empty:
            return 0.0, words
        best: dict[int, float] = {}
        spared = []
        for end, (size, weight) in self.automaton.iter(folded):
            start = end - size + 1
            if start and folded[start - 1].isalnum():
                continue
            if not weight:
                spared.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        if spared:
            best = {s: w for s, w in best.items() if not any(a <= s <= b for a, b in spared)}
        return sum(best.values()), words

    def score(self, text: str | None) -> float:
        weight, words = self.features(text)
        return 1 / (1 + math.exp(-(self.lexicon.bias + self.lexicon.slope * strength(weight, words))))


def strength(weight: float, words: int) -> float:
    """Weight for the length: a long text needs more of it, in proportion to the log of its words."""
    return weight / (1 + math.log1p(words))


def _beginnings(text: str | None) -> set[str]:
    words = {w[:LONGEST] for w in WORD.findall(fold(text))}
    return {w[:n] for w in words for n in range(SHORTEST, len(w) + 1)}


def _document_counts(texts: DataFrame, among: Sequence[str] | None = None) -> DataFrame:
    """(entry, documents): in how many texts a word beginning occurs; only those `among`, if given."""
    wanted = None if among is None else texts.sparkSession.sparkContext.broadcast(frozenset(among))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts: dict[str, int] = {}
            for text in batch.column("text").to_pylist():
                found = _beginnings(text)
                for entry in found if wanted is None else found & wanted.value:
                    counts[entry] = counts.get(entry, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                ["entry", "n"],
            )

    counted = texts.select("text").mapInArrow(run, "entry string, n long")
    return counted.groupBy("entry").agg(F.sum("n").alias("documents"))


def _entries(texts: DataFrame, weights: dict[str, float]) -> DataFrame:
    """The entries in each text."""
    wanted = texts.sparkSession.sparkContext.broadcast(frozenset(weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [sorted(_beginnings(t) & wanted.value) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string()))], ["entries"])

    return texts.select("text").mapInArrow(run, "entries array<string>")


def pruned(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Entries with their weights: of beginnings of one another, the one that says most.

    A shorter beginning goes if a longer one is in nearly the same toxic documents, a longer one if
    a shorter one weighs about as much.
    """
    weights = {
        e: math.log((t + 0.5) / (n_toxic + 1)) - math.log((clean.get(e, 0) + 0.5) / (n_clean + 1))
        for e, t in toxic.items()
    }
    least = 2 * math.log(max(len(toxic), 1)) + MARGIN
    expected = n_toxic / (n_toxic + n_clean)

    def statistic(e: str) -> float:
        t, c = toxic[e], clean.get(e, 0)
        by_class = (t, expected), (c, 1 - expected)
        return 2 * sum(n * math.log(n / ((t + c) * share)) for n, share in by_class if n)

    weights = {e: w for e, w in weights.items() if w >= LEAST_WEIGHT and statistic(e) >= least}
    covered = {
        e[:n] for e in weights for n in range(SHORTEST, len(e))
        if e[:n] in weights and toxic[e] >= 0.95 * toxic[e[:n]]
    }
    kept: dict[str, float] = {}
    for e in sorted(weights.keys() - covered, key=lambda e: (len(e), e)):
        shorter = [kept[e[:n]] for n in range(SHORTEST, len(e)) if e[:n] in kept]
        if not shorter or weights[e] > max(shorter) + 1:
            kept[e] = weights[e]
    return kept


def needed(documents: list[list[str]], weights: dict[str, float], least: int) -> dict[str, float]:
    """Of the entries, those that explain toxic documents which no better entry explains.

    `documents` has the entries in each toxic document, which is explained once EXPLAINED of them are
    taken. The entry with most weight over unexplained documents is taken, until none is in `least`
    of them. Words that only copies of a toxic document share are
    thus left out: what made the document toxic explains its copies as well.
    """
    holders: dict[str, set[int]] = {}
    for i, found in enumerate(documents):
        for e in found:
            holders.setdefault(e, set()).add(i)
    kept, times = {}, [0] * len(documents)
    while holders:
        best = max(holders, key=lambda e: (len(holders[e]) * weights[e], e))
        held = holders.pop(best)
        if len(held) < least:
            holders = {e: left for e, left in holders.items() if len(left) >= least}
            continue
        kept[best] = weights[best]
        for i in held:
            times[i] += 1
        explained = {i for i in held if times[i] >= EXPLAINED}
        holders = {e: left for e, h in holders.items() if (left := h - explained)}
    return kept


def fitted_curve(strengths: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Bias and slope of a logistic curve, both classes weighing the same, by Newton steps.

    Two made-up rows (one of each class, at the mean of both) keep separable data finite.
    """
    middle = strengths.mean() if len(strengths) else 0.0
    x = np.column_stack([np.ones(len(strengths) + 2), np.append(strengths, [middle, middle])])
    y = np.append(toxic, [0.0, 1.0])
    share = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()) * len(y)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (share * (y - p)) - 0.01 * beta
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        beta = beta + np.linalg.solve(curve, slope)
    return min(float(beta[0]), -0.5), float(beta[1])


def training_rows(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) that may be learned from: crc32(doc_id) mod 5 is not 0, a bounded sample.

    A document that is labelled both ways counts as toxic.
    """
    usable = labels.filter(
        (remainder(F.col("doc_id"), 5) != 0) & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)
    ).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    draw = [F.xxhash64("doc_id"), F.col("doc_id")]
    return usable.filter("toxic = 1").orderBy(*draw).limit(TOXIC_ROWS).unionByName(
        usable.filter("toxic = 0").orderBy(*draw).limit(CLEAN_ROWS)
    )


def learn(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """The lexicon of labelled documents. Only counts, entries and the sample's strengths are collected.

    Without labelled rows of both kinds, or without a word that tells them apart, the lexicon is empty
    and every score is below one half. A text without a match always scores below one half.
    """
    rows = F.broadcast(training_rows(labels))
    sample = docs.select("doc_id", "text").join(rows, "doc_id").cache()
    try:
        sizes = dict(sample.groupBy("toxic").count().collect())
        if not sizes.get(1) or not sizes.get(0):
            return Lexicon({})
        common = (
            _document_counts(sample.filter("toxic = 1"))
            .filter(F.col("documents") >= LEAST_DOCUMENTS)
            .orderBy(F.desc("documents"), "entry").limit(CANDIDATES)
        )
        toxic = dict(map(tuple, common.collect()))
        clean = dict(map(tuple, _document_counts(sample.filter("toxic = 0"), list(toxic)).collect()))
        weights = pruned(toxic, clean, sizes[1], sizes[0])
        explained = _entries(sample.filter("toxic = 1"), weights).toLocalIterator()
        least = max(LEAST_DOCUMENTS, sizes[1] // 200)
        weights = needed([row["entries"] for row in explained], weights, least)
        lexicon = Lexicon(weights)
        if not weights:
            return lexicon
        pairs = np.array(
            [(s, t) for s, t in _strengths(sample, lexicon).toLocalIterator()], dtype=float
        ).reshape(-1, 2)
        bias, slope = fitted_curve(pairs[:, 0], pairs[:, 1])
        return lexicon._replace(bias=bias, slope=slope)
    finally:
        sample.unpersist()


def _strengths(sample: DataFrame, lexicon: Lexicon) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in slices(batches, "text"):
            found = [strength(*matcher.features(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.float64()), batch.column("toxic").cast(pa.int32())],
                ["strength", "toxic"],
            )

    return sample.select("text", "toxic").mapInArrow(run, "strength double, toxic int")


def score_toxicity(docs: DataFrame, lexicon: Lexicon, keep: Iterable[str] = ()) -> DataFrame:
    """(doc_id, *keep, score, predicted): score from 0 to 1 of each whole text, predicted 1 from 0.5.

    Null and empty texts have no matches and score below one half. Null ids and repeated rows are
    scored like any other, an empty table gives no rows, other columns are not read. Nothing is
    shuffled; the lexicon, bounded by CANDIDATES, is sent to every task.
    """
    kept = ["doc_id", *(c for c in keep if c not in ("doc_id", "score", "predicted"))]
    read = list(dict.fromkeys([*kept, "text"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in slices(batches, "text"):
            scores = np.array([matcher.score(t) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(scores, pa.float64()),
                 pa.array((scores >= 0.5).astype(np.int32))],
                [*kept, "score", "predicted"],
            )

    fields = [docs.schema[c] for c in kept]
    fields += [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return docs.select(*read).mapInArrow(run, T.StructType(fields))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are not predicted toxic, with all their columns as they were.

    Columns other than doc_id and text travel as one struct, so none can be taken for a score.
    Odd rows as `score_toxicity` states; repeated rows stay or go together.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    row = [F.struct(*(F.col(f"`{c}`") for c in others)).alias("row")] if others else []
    scored = score_toxicity(docs.select("doc_id", "text", *row), learn(docs, labels), ["text", "row"][: 1 + len(row)])
    return scored.filter("predicted = 0").select(
        *(F.col("row").getField(c).alias(c) if c in others else F.col(c) for c in docs.columns)
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = learn(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, lexicon)
    return scored.select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted"
    )


QUERIES = {"op7_toxicity": op7_toxicity}
#: A learned lexicon is not expressible in SQL: the tests measure held-out accuracy.
ORACLES: dict[str, str] = {}
