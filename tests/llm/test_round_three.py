"""Importance resampling, sharding and the prefix trie against plain Python on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import minhash, prefix_trie, resampling, sharding
from panelkit.storage import new_path

# ------------------------------------------------------------------------------------ resampling

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _features(text):
    words = WORDS.findall((text or "").encode().lower())
    return words, words + [a + b" " + b for a, b in zip(words, words[1:])]


def _brute(docs, targets, percent=25, least=20):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(zlib.crc32(f) % 10000 for f in _features(text)[1])
    for text in targets:
        t.update(zlib.crc32(f) % 10000 for f in _features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000))))

    rows = []
    for doc_id, text in docs:
        words, found = _features(text)
        weight = sum(gain(zlib.crc32(f) % 10000) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(words), len(found), weight, score))
    able = sorted((r for r in rows if r[1] >= least),
                  key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = [(*r, i + 1) for i, r in enumerate(able[: percent * len(able) // 100])]
    left = Counter(rows) - Counter(r[:5] for r in drawn)
    return Counter((r[0], *r[2:]) for r in drawn) + Counter(
        {(r[0], *r[2:], None): n for r, n in left.items()}
    )


@pytest.fixture(scope="module")
def odd_docs():
    draw = random.Random(5)
    vocabulary = ["Été", "x1", "漢字", "the", "The", "a" * 300, "zz", "\x7f", "q-q"] + [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(draw.choices(vocabulary, k=draw.choice([0, 5, 19, 20, 60])))) for i in range(120)]
    docs += [(None, None), (None, "the " * 30), (None, "the " * 30), (7, "w1 " * 25), (7, "w1 " * 25),
             (7, "w2 " * 40), (500, ""), (501, "!!!"), (502, "b" * 100_000 + " c " + "b" * 100_000 + " d" * 30),
             (503, "long words " + " ".join(f"{i}" * 300 for i in range(30)))]
    return docs


def _rows(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


def test_resampling_equals_brute_force(spark, odd_docs):
    targets = ["the w1 w2 W3", None, "", "été 漢字 " * 20]
    docs = spark.createDataFrame(odd_docs, "doc_id long, text string").withColumn("rank", F.lit("mine"))
    target = spark.createDataFrame([(t,) for t in targets], "text string")
    wanted = _brute(odd_docs, targets)
    assert _rows(resampling.resample(docs, target)) == wanted
    turned = docs.orderBy(F.desc("doc_id"), F.desc("text")).repartition(3)
    got = resampling.resample(turned, target)
    assert _rows(got) == wanted and got.columns == ["doc_id", "text", "n_features", "weight", "score", "rank"]


def test_resampling_of_empty_tables(spark, odd_docs):
    docs = spark.createDataFrame(odd_docs, "doc_id long, text string")
    none = docs.limit(0)
    assert resampling.resample(none, docs).count() == 0
    assert _rows(resampling.resample(docs, none)) == _brute(odd_docs, [])
    assert _rows(resampling.resample(docs.filter("doc_id = 500"), docs)).total() == 1


def test_crc_of_joined_words_follows_from_the_parts():
    draw = random.Random(2)
    for n in (0, 1, 2, 255, 256, 70_000):
        a, b = draw.randbytes(draw.randrange(1, 50)), draw.randbytes(n)
        got = resampling.shifted(np.array([zlib.crc32(a)], np.uint32), np.array([n])) ^ np.uint32(zlib.crc32(b))
        assert got[0] == zlib.crc32(a + b)


# ------------------------------------------------------------------------------------ sharding


def _shard_brute(docs, shards):
    """Shards by the rule, over the sorted list; `docs` are (doc_id, text) with distinct ids."""
    def keys(row):
        return (hashlib.md5((row[1] or "").encode()).hexdigest()[:15],
                hashlib.md5(("" if row[0] is None else str(row[0])).encode()).hexdigest()[:16])

    ordered = sorted(docs, key=keys)
    sizes = [len((t or "").encode()) + 8 for _, t in ordered]
    total, starts = sum(sizes), np.concatenate([[0], np.cumsum(sizes)]).tolist()
    end_of = {}
    for row, end in zip(ordered, starts[1:]):
        end_of[keys(row)[0]] = end
    points = []
    for j in range(1, shards):
        i = next(i for i, end in enumerate(starts[1:]) if end * shards >= j * total)
        group = end_of[keys(ordered[i])[0]]
        near = (group - total // shards // 100) * shards <= j * total
        points.append(group if near else starts[i + 1])
    out, slots = Counter(), Counter()
    for row, start in zip(ordered, starts):
        shard = sum(p <= start for p in points)
        out[(row[0], shard, slots[shard])] += 1
        slots[shard] += 1
    return out


@pytest.mark.parametrize("hot", [0, 400, 3000])
def test_shards_equal_brute_force(spark, hot):
    draw = random.Random(hot)
    docs = [(i, "text " * draw.randrange(30) + str(draw.randrange(300))) for i in range(1200)]
    docs += [(5000 + i, "a copy of one text " * 3) for i in range(hot)]
    docs += [(9000, None), (9001, ""), (9002, "long " * 20_000), (9003, "漢" * 50), (None, "漢" * 50)]
    draw.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("shard", F.lit("mine"))
    got = sharding.sharded(df.repartition(5), 7)
    assert got.columns == ["doc_id", "text", "shard", "slot"]
    assert Counter(tuple(r) for r in got.select("doc_id", "shard", "slot").collect()) == _shard_brute(docs, 7)


def test_repeated_rows_are_split_and_slots_have_no_gaps(spark):
    rows = [(None, None)] * 900 + [(3, "same")] * 900 + [(i, f"t{i}") for i in range(900)]
    got = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string"), 9).toPandas()
    bytes_ = got["text"].fillna("").str.len() + 8
    sums = bytes_.groupby(got["shard"]).sum()
    assert len(got) == 2700 and sums.max() - sums.min() <= 2 * (sums.mean() / 100 + 16)
    for _, slots in got.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))


def test_no_rows_and_written_shards(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.sharded(empty).count() == 0
    docs = spark.createDataFrame([(i, "x" * i) for i in range(50)], "doc_id long, text string")
    path = new_path(spark, "shards")
    sharding.write_shards(sharding.sharded(docs, 4), path)
    back = spark.read.parquet(path)
    assert back.count() == 50 and back.select("shard").distinct().count() == 4
    assert spark.read.parquet(f"{path}/shard=2").columns == ["doc_id", "text", "slot"]


# ------------------------------------------------------------------------------------ prefix trie


def _trie_brute(rows, rebuild=True):
    """Nodes by the definition. Turns of a conversation that share a number hold the same words."""
    turns = {}
    for conv, turn, role, text in sorted(
        (r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)
    ):
        turns.setdefault(conv, []).append((role or "", text or ""))
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = turns.get(c - c % 100, [])[:h] + own[h:] if rebuild else own
    members = {}
    for c, said in built.items():
        for d in range(len(said) + 1):
            members.setdefault(tuple(said[:d]), []).append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for node, held in members.items():
        children[node[:-1]] += bool(node)
        ends = all(len(built[c]) == len(node) for c in held)
        for d in range(len(node) + 1):
            leaves[node[:d]] += ends
            saved[node[:d]] += (len(held) - 1) * (len(node[-1][1]) if node else 0)
    out = Counter()
    for node, held in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in held if len(built[c]) == len(node)))
        out[(
            min(held), len(node), min(members[node[:-1]]) if node else None, len(held), children[node],
            leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        )] += 1
    return out


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.fixture(scope="module")
def talks():
    draw = random.Random(11)
    rows = []
    for c in [*range(60), *range(100, 140), 250, 251, 300]:
        rows += [(c, t, draw.choice(["user", None]), draw.choice(["yes", "no", "", None, "漢字"]))
                 for t in range(draw.randrange(1, 9))]
    rows += [(c, t, "user", f"same {t}") for c in range(400, 420) for t in range(6)]
    rows += [(500 + k, t, "user", f"deep {t if t < 30 * k else -k}") for k in range(4) for t in range(100)]
    rows += [(600, None, "user", "first"), (600, 0, "user", "then"), (600, 0, "user", "then"), (601, None, None, None),
             (None, 1, "user", "nobody"), (699, 3, "x", "long " * 40_000), (699, -5, "x", "before")]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [512, 7])
@pytest.mark.parametrize("rebuild", [True, False])
def test_trie_equals_brute_force(spark, talks, monkeypatch, block, rebuild):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "SHARD_ROWS", 500 if block == 7 else 200_000)
    df = spark.createDataFrame(talks, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit("mine"))
    got = prefix_trie.prefix_trie(df.repartition(4), rebuild)
    assert Counter(tuple(r) for r in got.select(*NODE).collect()) == _trie_brute(talks, rebuild)


def test_trie_of_no_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.prefix_trie(empty).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_slots_are_a_minimal_perfect_hash(n):
    draw = np.random.default_rng(n)
    p, q = draw.integers(-(2**63), 2**63, n), draw.integers(-3, 3, n)
    p[: n // 2] = 9
    q[: n // 2] = np.arange(n // 2) + 5
    slots = prefix_trie.SlotTable(p, q)
    assert sorted(slots.slots(p, q)) == list(range(n))
    assert (slots.slots(p ^ 1, q) == -1).all()


# ------------------------------------------------------------------------------------ repeated ids


def _near(words, n):
    return " ".join(words[:-n] + [f"other{i}" for i in range(n)])


def test_repeated_ids_link_alike_in_every_order(spark):
    """Two texts under one id, a near copy of each under others: one document ties all of them."""
    one, two = ([f"{c}{i}" for i in range(80)] for c in "ab")
    rows = [(1, " ".join(one)), (1, " ".join(two)), (2, _near(one, 3)), (3, _near(two, 3)),
            (0, _near(two, 4)), (5, "quite another text of a few words"), (5, ""), (4, None), (6, "")]
    wanted = {0: 0, 1: 0, 2: 0, 3: 0, 4: 4, 5: 5, 6: 6}
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1 + seed % 2)
        got = minhash.link_documents(docs, 80).collect()
        assert len(got) == len(rows) and {r["doc_id"]: r["component_id"] for r in got} == wanted
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
        kept = minhash.without_near_duplicates(docs, 80).collect()
        assert sorted(r["doc_id"] for r in kept) == [0, 4, 5, 6]
        assert {tuple(r) for r in kept} == {tuple(r) for r in minhash.without_near_duplicates(docs.repartition(3), 80).collect()}
