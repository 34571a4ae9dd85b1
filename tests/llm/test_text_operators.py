"""BPE, quality rules, toxicity, quality model, near duplicates and mixing on small fixtures."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelkit.llm import bpe, minhash, mixing, quality_model, quality_rules, toxicity
from panelkit.llm.shingles import shingle_sets

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BLANK = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in BLANK.split(text or "") if w]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and very long texts, ties, repeated rows, a clashing extra column."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [
        (1, "a b c d e f g", "en", "s1", 3), (2, "a b c d e f g", "en", "s1", 3), (3, "", "en", None, 0),
        (4, None, None, None, None), (None, "null id here", "en", "s2", 5), (5, long, "en", "s2", 9),
        (6, "one", "en", "s3", 1), (6, "one", "en", "s3", 1), (7, " \n\t ", "en", "s1", 2),
        (8, "é漢字😀 <|endoftext|> x", "en", "s3", 4), (9, "z" * 5000, "en", "s3", 4),
    ]
    return spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("clash")).withColumn("score", F.lit(1))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int")


def test_bpe_equals_the_library():
    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    own = bpe.ByteBpe(open(path("byte_bpe_50k.json"), encoding="utf-8").read())
    rng = random.Random(5)
    letters = "aeiou thxyz  \n\t\r'sSré漢字😀\x1c\x85　\xa0123½.,;--<|endoftext|>\x00​ 'll're"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 120))) for _ in range(800)]
    texts += ["a" * 3000, "<|endoftext|>x<|endoftext|>", "", "   ", "don't we'LL", "ab" * 999]
    for got, wanted, text in zip(own.encode(texts), tokenizer.encode_batch(texts, add_special_tokens=False), texts, strict=True):
        assert np.frombuffer(got, "<u4").tolist() == wanted.ids
        assert own.decode(got) == tokenizer.decode(wanted.ids, skip_special_tokens=False) == text


def test_bpe_documents(spark, odd):
    rows = bpe.encode_documents(odd, bpe.default_tokenizer()).collect()
    assert len(rows) == odd.count()
    back = bpe.decode_documents(bpe.encode_documents(odd, bpe.default_tokenizer()), bpe.default_tokenizer())
    texts = Counter((r["doc_id"], r["text"] or "") for r in odd.select("doc_id", "text").collect())
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == texts
    digests = bpe.encode_documents(odd.filter("doc_id = 4"), bpe.default_tokenizer(), digests=True).first()
    assert digests["n_tokens"] == 0 and digests["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    assert bpe.encode_documents(odd.limit(0), bpe.default_tokenizer()).count() == 0


def brute_rules(texts, trusted):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score."""
    grams, base = [], []
    for text in texts:
        ws, text = words(text), text or ""
        windows = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
        times = Counter(windows)
        inside = {k for i, w in enumerate(windows) if times[w] > 1 for k in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if words(x)]
        base.append((len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)))
        mask = quality_rules.BUCKETS - 1
        one = [xxhash.xxh64_intdigest(w.encode(), 42) for w in ws]
        two = [xxhash.xxh64_intdigest(b.encode(), a) for a, b in zip(one, ws[1:])]
        grams.append([h & mask for h in one + two])
    raw = Counter(g for x in grams for g in x)
    target = Counter(g for x, t in zip(grams, trusted) if t for g in x)
    n_raw, n_target = sum(raw.values()), sum(target.values())

    def ratio(g):
        if not n_target:
            return 0.0
        return math.log((target[g] + 10) / (raw[g] * n_target / n_raw + 10))

    return [(*b, sum(map(ratio, x)) / len(x) if x else 0.0) for b, x in zip(base, grams)]


def test_quality_rules_equal_brute_force(spark, folder, odd, labels):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    trusted = quality_rules.trusted_ids(spark.read.parquet(f"{folder}/labels.parquet"))
    for table, good in ((docs, trusted), (odd, quality_rules.trusted_ids(labels)), (odd, quality_rules.trusted_ids(labels.limit(0)))):
        ids = {r[0] for r in good.collect()}
        got = quality_rules.judged(table, good).collect()
        wanted = brute_rules([r["text"] for r in got], [r["doc_id"] in ids for r in got])
        for row, (n, chars, symbols, lines, repeats, score) in zip(got, wanted, strict=True):
            assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == (n, chars, symbols, lines, repeats)
            assert row["score"] == pytest.approx(score, abs=1e-9)
            failed = n < 50 or 100 * repeats > 50 * n
            assert row["base_failed"] == failed and row["kept"] == (not failed and row["score"] >= quality_rules.THRESHOLD)
    assert quality_rules.judged(odd.limit(0), quality_rules.trusted_ids(labels)).count() == 0


def test_toxicity_folds_and_spares():
    lexicon = toxicity.Lexicon({"idiot": 6.0, "trash": 6.0}, bias=-3.0, slope=4.0)
    matcher = toxicity.Matcher(lexicon)
    for text in ("an idiot", "1D10T", "іdіоt", "id​iot", "ＩＤＩＯＴ", "idiots", "trash"):
        assert matcher.score(text) > 0.5, text
    for text in ("", None, "trash can", "unidiot", "idio t", "calm words " * 1000):
        assert matcher.score(text) < 0.5, text
    many = toxicity.Matcher(lexicon)
    assert many.score("idiot") > many.score("idiot " + "calm " * 5000)


def test_toxicity_learns(spark, folder, odd, labels):
    rng = random.Random(3)
    plain = [f"{a}{b}{c}" for a in ("lo", "mi", "ra") for b in ("tun", "der", "pos") for c in ("ka", "les", "um")]
    bad = ["grumpf", "sludge", "blergh"]
    rows = []
    for i in range(1500):
        toxic = int(rng.random() < 0.15)
        ws = [rng.choice(plain) for _ in range(rng.randint(5, 80))]
        if toxic:
            ws[rng.randrange(len(ws))] = rng.choice(bad)
        rows.append((i, " ".join(ws), toxic, 1))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int, quality int")
    lexicon = toxicity.learn(table.select("doc_id", "text"), table)
    assert set(lexicon.weights) == set(bad)
    scored = toxicity.score_toxicity(table.select("doc_id", "text"), lexicon).join(table, "doc_id")
    held_out = scored.filter("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0")
    assert held_out.filter("predicted <> toxic").count() == 0 and held_out.count() > 200
    nothing = toxicity.learn(odd, labels)
    assert nothing.weights == {}
    got = toxicity.score_toxicity(odd, nothing, odd.columns)
    assert got.count() == odd.count() and got.filter("score >= 0.5 or score is null").count() == 0
    assert toxicity.without_toxic(odd, labels).columns == odd.columns
    assert toxicity.without_toxic(odd.limit(0), labels).count() == 0


def test_documents_keep_columns_named_like_scores(spark, labels):
    rows = [(1, "kind words", 1, "x", 2), (2, None, 0, None, 3), (2, None, 0, None, 3), (None, "", None, "y", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int, `pre.dicted` string, predicted int")
    got = toxicity.without_toxic(docs, labels)
    assert got.dtypes == docs.dtypes
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)
    bare = docs.select("text", "doc_id")
    assert sorted(map(tuple, toxicity.without_toxic(bare, labels).collect()), key=str) == sorted(((t, i) for i, t, *_ in rows), key=str)


def test_conflicting_labels_count_as_toxic_in_any_order(spark):
    pairs = [(i, t) for i in range(1, 40) for t in (0, 1)]
    for order in (pairs, pairs[::-1]):
        labels = spark.createDataFrame(order, "doc_id long, toxic int")
        assert {r["toxic"] for r in toxicity.training_rows(labels).collect()} == {1}


def test_quality_model_learns(spark, folder, odd, labels):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    truth = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    some = docs.filter("doc_id < 4000")
    model = quality_model.learn(some, truth)
    assert 0.75 < model.prior < 0.97
    held_out = quality_model.score_quality(some, model).join(truth, "doc_id").filter(
        "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2"
    )
    rows = held_out.select("score", "predicted", "quality").toPandas()
    assert (rows["predicted"] == rows["quality"]).mean() > 0.9
    ranks = rows["score"].rank()
    good = rows["quality"] == 1
    area = (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert area > 0.95
    nothing = quality_model.learn(odd, labels)
    got = quality_model.score_quality(odd, nothing)
    assert got.count() == odd.count() and got.filter("score is null or score < 0 or score > 1").count() == 0
    assert quality_model.score_quality(odd.limit(0), nothing).count() == 0


def test_non_negative_risk_finds_the_prior():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(1.5, 1, (3000, 4)), rng.normal(-1.5, 1, (900, 4))
    model = quality_model.fit(good[:1500], np.vstack([good[1500:], bad]))
    assert model.prior == pytest.approx(0.625, abs=0.08)
    right = np.concatenate([model.scores(good[:500]) >= 0.5, model.scores(bad) < 0.5])
    assert right.mean() > 0.95


def brute_groups(rows, percent):
    """{doc_id: (n_shingles, component)} by comparing all pairs of sets."""
    sets = {}
    for doc_id, text in rows:
        ws = (text or "").encode().lower().split()
        sets[doc_id] = {tuple(ws[k : k + 5]) for k in range(len(ws) - 4)} if len(ws) >= 5 else ({tuple(ws)} if ws else set())
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                a, b = top(a), top(b)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in sets}


def planted(n_near):
    """A hub with near copies on either side of the threshold, a chain, copies, a shared passage."""
    rng = random.Random(11)
    pool = [f"{a}{b}" for a in "bcdfghjklmnp" for b in ("ar", "en", "il", "os", "um", "yt")]

    def text(n):
        return [rng.choice(pool) + str(rng.randrange(50)) for _ in range(n)]

    hub, docs = text(120), []
    for _ in range(n_near):
        copy = list(hub)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = "edit" + str(rng.randrange(10**6))
        docs.append(copy)
    chain = text(200)
    for k in range(0, 60, 6):
        docs.append(chain[k : k + 140])
    docs += [text(80)] * 20 + [["same", "three", "words"]] * 3 + [["Same", "THREE", "words"], [], ["one"]]
    passage = text(60)
    docs += [text(30) + passage + text(rng.randint(5, 40)) for _ in range(60)]
    return list(enumerate(" ".join(d) for d in docs))


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_equal_all_pairs(spark, percent, monkeypatch):
    monkeypatch.setattr(minhash, "CHUNK", 64)
    rows = planted(150)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.link_documents(docs, percent).collect()}
    assert got == brute_groups(rows, percent)


def test_separate_pairs_are_all_linked(spark):
    """Ten thousand pairs that nothing else ties together, against their shared shingles."""
    rng, rows, wanted = random.Random(11), [], {}
    for i in range(10_000):
        first = [f"{rng.randrange(2**32):x}" for _ in range(104)]
        cut = 6 + i % 6
        second = first[:-cut] + [f"{rng.randrange(2**32):x}" for _ in range(cut)]
        rows += [(2 * i, " ".join(first)), (2 * i + 1, " ".join(second))]
        x, y = ({tuple(w[k:k + 5]) for k in range(100)} for w in (first, second))
        wanted[2 * i] = 2 * i
        wanted[2 * i + 1] = 2 * i if 100 * len(x & y) >= 80 * len(x | y) else 2 * i + 1
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: r["component_id"] for r in minhash.link_documents(docs, 80).collect()}
    assert [i for i in wanted if got[i] != wanted[i]] == []


def test_near_duplicates_of_odd_rows(spark, odd):
    got = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in minhash.link_documents(odd, 85).collect()}
    assert got[1, 3] == (1, True) and got[2, 3] == (1, False)
    assert got[3, 0] == (3, True) and got[4, 0] == (4, True) and got[None, 1] == (None, True) and got[6, 1] == (6, True)
    kept = minhash.without_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7, 8, 9]
    assert minhash.link_documents(odd.limit(0), 85).count() == 0


def test_pruning_keeps_what_may_reach_the_threshold():
    rng = random.Random(2)
    for similar in (0.86, 0.9, 0.97):
        kept = 0
        for _ in range(40):
            both = [rng.randrange(2**60) for _ in range(400)]
            only = int(400 * (1 - similar) / (1 + similar))
            sets = [np.unique(np.array(both[only:] + [rng.randrange(2**60) for _ in range(only)], dtype=np.uint64)) for _ in range(2)]
            marks = minhash.marks_of(minhash.minima(sets, minhash.LONG))
            kept += len(minhash.surviving(marks[:1], marks[1:], 0.85))
        assert kept == 40
    assert [len(s) for s in shingle_sets([None, "", "a b", "a b c d e f"])] == [0, 0, 1, 2]


def test_mixing_reaches_its_targets(spark, folder, odd):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source", "text")
    rows = mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken").toPandas()
    assert (rows["taken"] <= 3 * rows["size"]).all() and (rows["taken"] % rows["size"].clip(lower=1) == 0).all()
    for _, part in rows.groupby("source"):
        assert part["source_size"].eq(part["size"].sum()).all()
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= part["size"].max() / 2 + 1
    assert rows.drop_duplicates("source")["target"].sum() == pytest.approx(rows["size"].sum())
    again = mixing.mix(docs.repartition(3)).select("doc_id", "taken").toPandas()
    assert sorted(map(tuple, again.to_numpy())) == sorted(map(tuple, rows[["doc_id", "taken"]].to_numpy()))
    times = (rows["taken"] // rows["size"].clip(lower=1)).sum()
    assert mixing.mixed_documents(docs).count() == times


def test_mixing_of_odd_rows(spark, odd):
    rows = mixing.mix(odd)
    assert rows.columns == [c for c in odd.columns if c != "size"] + ["size", "source_size", "target", "taken"]
    got = rows.collect()
    assert len(got) == odd.count() and all(r["taken"] == 0 for r in got if not r["text"])
    assert all(r["target"] <= 3 * r["source_size"] for r in got)
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert mixing.mix(odd.limit(0)).count() == 0
    assert zlib.crc32(b"1") % 7 == odd.filter("doc_id = 1").select(F.crc32(F.lit(b"1")) % 7).first()[0]
