"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

The symbols of many words stand in one flat array. In each round the rank of every neighbouring pair
is found by binary search over the sorted pair keys, every word merges all occurrences of its
lowest-ranked pair, and finished words leave the array. A word's symbols never need Python loops.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from panelkit.llm.common import slices, table

#: Fixed value: how this family of vocabularies splits a text before the merges.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Words whose ids a task keeps between slices.
KEPT_WORDS = 400_000
NEVER = np.int64(1) << 40
SHIFT = 20


def _byte_letters() -> list[str]:
    """The letter that a vocabulary file writes for each byte: itself if printable, else 256 and up."""
    printable = set(chain(range(33, 127), range(161, 173), range(174, 256)))
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class ByteBpe:
    """A vocabulary file, ready for batches of words."""

    def __init__(self, text: str):
        content = json.loads(text)
        vocabulary = content["model"]["vocab"]
        letters = _byte_letters()
        back = {c: b for b, c in enumerate(letters)}
        self.first = np.array([vocabulary[c] for c in letters], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"]]
        keys = np.array(
            [(vocabulary[a] << SHIFT) + vocabulary[b] for a, b in pairs], dtype=np.int64
        )
        merged = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = merged
        self.special = {x["content"]: x["id"] for x in content["added_tokens"]}
        size = max([*vocabulary.values(), *self.special.values()]) + 1
        self.bytes = [b""] * size
        for piece, i in vocabulary.items():
            self.bytes[i] = bytes(back[c] for c in piece)
        for piece, i in self.special.items():
            self.bytes[i] = piece.encode()
        self.pattern = regex.compile(SPLIT)
        named = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, named))) if named else None
        self.known: dict[str, bytes] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs by binary search over the sorted keys; NEVER for those without a merge."""
        wanted = (left << SHIFT) + right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.ranks[at], NEVER)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as little-endian unsigned 32-bit integers; no word may be empty."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        symbols = self.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.arange(len(words))
        out: list[bytes] = [b""] * len(words)
        ends = np.cumsum(lengths)
        ranks = np.full(len(symbols), NEVER)
        ranks[:-1] = self._rank(symbols[:-1], symbols[1:])
        ranks[ends - 1] = NEVER
        while len(word):
            starts = np.cumsum(lengths) - lengths
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == NEVER
            if done.any():
                flat = np.repeat(done, lengths)
                packed = symbols[flat].astype("<u4").tobytes()
                at = 0
                for w, n in zip(word[done].tolist(), lengths[done].tolist(), strict=True):
                    out[w] = packed[at : at + 4 * n]
                    at += 4 * n
                word, lengths, lowest = word[~done], lengths[~done], lowest[~done]
                symbols, ranks = symbols[~flat], ranks[~flat]
                if not len(word):
                    break
            hit = np.flatnonzero(ranks == np.repeat(lowest, lengths))
            # In a run such as "aaa" the pairs overlap: every second one merges, from the left.
            fresh = np.ones(len(hit), dtype=bool)
            fresh[1:] = np.diff(hit) > 1
            begin = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - begin) % 2 == 0]
            symbols[hit] = self.merged[ranks[hit]]
            last = np.zeros(len(symbols), dtype=bool)
            last[np.cumsum(lengths) - 1] = True
            last[hit] |= last[hit + 1]
            keep = np.ones(len(symbols), dtype=bool)
            keep[hit + 1] = False
            owner = np.repeat(np.arange(len(word)), lengths)[hit]
            lengths = lengths - np.bincount(owner, minlength=len(word))
            symbols, ranks, last = symbols[keep], ranks[keep], last[keep]
            hit = hit - np.arange(len(hit))
            ranks[hit[last[hit]]] = NEVER
            changed = np.unique(np.concatenate([hit[~last[hit]], hit[hit > 0] - 1]))
            changed = changed[~last[changed]]
            ranks[changed] = self._rank(symbols[changed], symbols[changed + 1])
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, packed as in `merge`. Names of special tokens in a text become them."""
        split = []
        for text in texts:
            parts = [text]
            if self.specials and self.specials.search(text):
                parts = regex.split(f"({self.specials.pattern})", text)
            split.append([
                [p] if i % 2 else self.pattern.findall(p) for i, p in enumerate(parts)
            ])
        if len(self.known) > KEPT_WORDS:
            self.known = {}
        if not self.known:
            self.known = {t: i.to_bytes(4, "little") for t, i in self.special.items()}
        new = list(set(chain.from_iterable(chain.from_iterable(split))) - self.known.keys())
        if new:
            self.known.update(zip(new, self.merge([w.encode() for w in new]), strict=True))
        ids = self.known.__getitem__
        return [b"".join(map(ids, chain.from_iterable(parts))) for parts in split]

    def decode(self, packed: bytes) -> str:
        """The text of packed ids; bytes that are no UTF-8 become replacement characters."""
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


_loaded: dict[str, ByteBpe] = {}


def loaded(content: str) -> ByteBpe:
    """The tables of a vocabulary, built once per Python worker."""
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = ByteBpe(content)
    return _loaded[key]


def encode_documents(docs: DataFrame, tokenizer_path: str, digests: bool = False) -> DataFrame:
    """Every row of `docs` with doc_id, n_tokens and the ids of its whole text.

    With `digests`, the SHA-256 of the packed ids and of the text decoded from them stand in place
    of the ids. A null text counts as empty: no tokens. Repeated rows and null ids are encoded like
    any other row, an empty table gives no rows, other columns are not read. Rows stay where they
    are: nothing is shuffled. The vocabulary file (1.6 MB, a fixed size) is read by the driver and
    broadcast. A task holds one slice of texts at a time; a word of a million letters costs one
    pass over its symbols for each pair rank that occurs in it.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(content.value)
        for batch in slices(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            packed = bpe.encode(texts)
            counts = pa.array([len(p) // 4 for p in packed], pa.int64())
            columns = [batch.column("doc_id"), counts]
            if digests:
                columns += [
                    pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                    pa.array([
                        hashlib.sha256(bpe.decode(p).encode()).hexdigest() for p in packed
                    ]),
                ]
            else:
                offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])])
                values = np.frombuffer(b"".join(packed), dtype="<i4")
                columns.append(pa.ListArray.from_arrays(offsets.astype(np.int32), values))
            yield pa.RecordBatch.from_arrays(columns, names)

    id_type = docs.schema["doc_id"].dataType
    fields = [T.StructField("doc_id", id_type), T.StructField("n_tokens", T.LongType())]
    if digests:
        fields += [T.StructField(c, T.StringType()) for c in ("ids_sha256", "decoded_sha256")]
    else:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    names = [f.name for f in fields]
    return docs.select("doc_id", "text").mapInArrow(run, T.StructType(fields))


def decode_documents(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids): the way back. Null ids give an empty text."""
    with open(tokenizer_path, encoding="utf-8") as f:
        content = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(content.value)
        for batch in batches:
            texts = [
                bpe.decode(np.asarray(ids or [], dtype="<u4").tobytes())
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    schema = T.StructType([encoded.schema["doc_id"], T.StructField("text", T.StringType())])
    return encoded.select("doc_id", "ids").mapInArrow(run, schema)


def default_tokenizer() -> str:
    from public_tokenizers import path

    return path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), default_tokenizer(), digests=True)


QUERIES = {"op1_bpe": op1_bpe}
#: Merges are not expressible in SQL: the tests compare with the tokenizers library.
ORACLES: dict[str, str] = {}
