"""WARC, language model, vectors, URLs, components, the pipeline and the registry."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from panelkit.llm import bpe, components, context_tree, pivots, registry, url_filter, warc
from panelkit.storage import new_path

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, folder, name):
    wanted = duck.execute(registry.oracle_sql()[name]).df()
    got = registry.queries()[name](spark, folder).toPandas()
    columns = sorted(wanted.columns)
    assert sorted(got.columns) == columns and len(got) == len(wanted)

    def rows(table):
        plain = table[columns].astype(object).where(table[columns].notna(), None)
        return sorted(
            (tuple(round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in r)
             for r in plain.itertuples(index=False)), key=repr,
        )

    assert rows(got) == rows(wanted)


# ------------------------------------------------------------------------------------ WARC


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [
        (1, "http://a/\r\nx", "same"), (2, "http://b/", "same"), (3, None, "same"), (4, "http://c/", None),
        (5, "http://d/", ""), (None, "http://e/", "same"), (6, "http://f/", "é漢" * 50_000), (7, "u", "tie"), (7, "u", "tie"),
        (8, "http://g/", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))


@pytest.mark.parametrize("least", [0, 4, 10**9])
def test_warc_round_trip(spark, odd_pages, least):
    folder = new_path(spark, "warc")
    archives = warc.write_archives(odd_pages, folder, least)
    got = warc.read_archives(archives, folder, payloads=True).collect()
    rows = odd_pages.collect()
    assert len(got) == len(rows) == sum(r["records"] for r in archives.collect())
    first = {}
    for r in rows:
        payload = (r["html"] or "").encode()
        if r["page_id"] is not None and len(payload) >= least:
            first[payload] = max(first.get(payload, 0), r["page_id"])
    wanted = Counter()
    for r in rows:
        payload = (r["html"] or "").encode()
        target = first.get(payload)
        revisit = r["page_id"] is not None and target is not None and r["page_id"] < target
        wanted[(
            r["page_id"], len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
            "revisit" if revisit else "response", target if revisit else None, None if revisit else payload,
        )] += 1
    assert Counter(
        (r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"],
         None if r["payload"] is None else bytes(r["payload"])) for r in got
    ) == wanted
    assert warc.read_archives(warc.write_archives(odd_pages.limit(0), new_path(spark, "none")), folder).count() == 0


def test_warc_keeps_bytes_that_are_no_utf8(spark):
    """Before, a page in another encoding ended the job with a UnicodeDecodeError."""
    latin, cut = "<p>Caf\xe9</p>".encode("latin-1"), "\u6f22".encode()[:2]
    raw = [(1, b"http://a/\xe9", latin), (2, b"http://b/", latin), (3, None, cut), (4, b"http://\xff/", b"plain"), (5, None, None)]
    pages = spark.createDataFrame(raw, "page_id long, url binary, html binary").selectExpr(
        "page_id", "cast(url AS string) AS url", "cast(html AS string) AS html"
    )
    folder = new_path(spark, "warc")
    found = warc.read_archives(warc.write_archives(pages, folder), folder, payloads=True)
    got = found.selectExpr("page_id", "cast(url AS binary) AS url", "record_type", "refers_to", "payload_bytes", "payload").collect()
    assert {
        (r.page_id, r.url and bytes(r.url), r.record_type, r.refers_to, r.payload_bytes, None if r.payload is None else bytes(r.payload))
        for r in got
    } == {
        (1, b"http://a/\xe9", "revisit", 2, len(latin), None), (2, b"http://b/", "response", None, len(latin), latin),
        (3, None, "response", None, 2, cut), (4, b"http://\xff/", "response", None, 5, b"plain"), (5, None, "response", None, 0, b""),
    }


def test_warc_reader_refuses_damage():
    one = warc.response_record(1, "http://a/", b"payload " * 1000)
    two = warc.revisit_record(2, None, hashlib.sha1(b"x").hexdigest(), 1, 1)
    whole = list(warc.read_records(io.BytesIO(one + two)))
    assert [h["warc-type"] for h, _ in whole] == ["response", "revisit"] and whole[0][1] == b"payload " * 1000
    assert gzip.decompress(one).startswith(b"WARC/1.1\r\n")
    plain = gzip.decompress(one)
    for broken in (
        (one + two)[:-9], gzip.compress(plain.replace(b"payload p", b"payload q", 1)), gzip.compress(plain[:-30]),
        gzip.compress(plain.replace(b"WARC/1.1", b"NONE/1.1")), gzip.compress(plain.replace(b"Length: 8000", b"Length: 7999")),
    ):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.read_records(io.BytesIO(broken)))


# ---------------------------------------------------------------------------- language model


def brute_tree(training):
    """A function (text) -> log10 probability, by context-tree weighting with plain dictionaries."""
    deep = context_tree.DEPTH
    counts = {}

    def steps(text):
        data = bytes(deep) + text.encode().lower() + b"\0"
        for k in range(deep, len(data)):
            context = tuple(data[k - 1 - i] for i in range(deep))
            node = 1
            for bit in range(7, -1, -1):
                one = data[k] >> bit & 1
                yield context, node, one
                node = 2 * node + one

    for text in training:
        for context, node, one in steps(text):
            for depth in range(deep + 1):
                counts.setdefault((context[:depth], node), [0, 0])[one] += 1
    longer = {}
    for context, node in counts:
        if context:
            longer.setdefault((context[:-1], node), []).append((context, node))

    def own(n):
        return math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.lgamma(n[0] + n[1] + 1) - math.log(math.pi)

    weighted = {}

    def whole(key):
        if key not in weighted:
            e = own(counts[key])
            weighted[key] = e if len(key[0]) == deep else math.log(0.5) + np.logaddexp(e, sum(map(whole, longer[key])))
        return weighted[key]

    def chance(context, node, depth):
        key = (context[:depth], node)
        n = counts.get(key, (0, 0))
        p = (n[1] + 0.5) / (sum(n) + 1)
        if depth == deep:
            return p
        w = math.exp(math.log(0.5) + own(n) - whole(key)) if key in counts else 0.5
        return w * p + (1 - w) * chance(context, node, depth + 1)

    def score(text):
        return sum(
            math.log10(p if one else 1 - p)
            for context, node, one in steps(text) for p in [chance(context, node, 0)]
        )

    return score


def test_scores_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").filter("length(text) < 900")
    rows = docs.collect()
    score = brute_tree([r["text"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2])
    got = {r["doc_id"]: r["score"] for r in context_tree.score_documents(docs).collect()}
    for r in rows[:40]:
        assert got[r["doc_id"]] == pytest.approx(score(r["text"]), rel=1e-5)


def test_learned_probabilities_add_up():
    """The 256 bytes after any context, seen or not, share all probability."""
    texts = [random.Random(i).choice(["the cat sat", "a dog ran far", "\xe9 cat"]).encode() + b" on it " * (i % 4) for i in range(60)]
    seen, n = np.unique(context_tree.context_keys(texts), return_counts=True)
    contexts = {int(k) >> 8 for k in seen[::7]} | {int.from_bytes(b"zz other"[:6], "big"), int(seen[5]) >> 8 ^ 1}
    every = np.array(sorted({c << 8 | b for c in contexts for b in range(256)} | set(seen.tolist())), np.uint64)
    counts = np.zeros(len(every), np.int64)
    counts[np.searchsorted(every, seen)] = n
    parts = (every >> np.uint64(40)).astype(np.int64)
    low = np.uint64((1 << 40) - 1)
    trees = {p: context_tree.Subtree(every[parts == p] & low, counts[parts == p]) for p in np.unique(parts).tolist()}
    top = context_tree.Top(np.array([p >> 8 for p in trees]), *(
        np.array([getattr(t, x) for t in trees.values()]) for x in ("log_weighted", "zero", "ones")))
    bits = np.concatenate([t.code_lengths(top, p >> 8) for p, t in trees.items()])
    for c in contexts:
        assert math.isclose((2.0 ** -bits[(every >> np.uint64(8)) == c]).sum(), 1.0, rel_tol=1e-9)


def test_more_text_predicts_better(spark, folder):
    """The tree grows with the corpus: bits a byte of the held-out texts fall."""
    bits = []
    for place in (folder, folder.replace("sf0.001", "sf0.01")):
        docs = spark.read.parquet(f"{place}/documents.parquet")
        sizes = docs.select("doc_id", (F.octet_length("text") + 1).alias("n"))
        held = context_tree.score_documents(docs).filter("held_out").join(sizes, "doc_id")
        bits.append(held.select(-F.sum("score") / F.sum("n") / math.log10(2)).first()[0])
    assert bits[1] < bits[0]


def test_lgamma():
    x = np.array([0.5, 1, 1.5, 2, 10.5, 1e3, 1e8])
    assert np.allclose(context_tree._lgamma(x), [math.lgamma(v) for v in x], atol=1e-9)


def test_scores_of_words_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    tokens = {r["doc_id"]: [*r["text"].encode().lower().split(), None] for r in docs.collect()}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = Counter(t for i, ts in tokens.items() if not out[i] for t in ts)
    whole = math.log10(sum(c.values()) + len(c) + 1)
    for r in context_tree.score_documents(docs).collect():
        ts = tokens[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            out[r["doc_id"]], len(ts), sum(c[t] > 0 for t in ts), sum(c.values()))
        assert r["base_score"] == pytest.approx(sum(math.log10(c[t] + 1) - whole for t in ts))
        assert r["score"] < 0


def test_scores_of_odd_rows(spark):
    rows = [(1, "a b"), (2, None), (3, ""), (None, "a b"), (4, "a b"), (4, "a b"), (5, "x" * 300_000), (6, "\0 é 漢")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("train", F.lit("clash"))
    got = context_tree.score_documents(docs).collect()
    assert len(got) == len(rows) and all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (2, 3)} == {1}
    assert context_tree.score_documents(docs.limit(0)).count() == 0


# ------------------------------------------------------------------------------------ vectors


def all_pairs(rows):
    """{vec_id: (n_links, component)} by comparing all pairs."""
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=float)
            good[i] = x / np.linalg.norm(x)
    links = {i: [j for j in good if j != i and len(good[i]) == len(good[j]) and good[i] @ good[j] >= 0.95] for i in good}
    found = {}
    for i in sorted(good):
        reach, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in reach:
                    reach.add(j)
                    todo.append(j)
        found[i] = (len(links[i]), min(reach))
    return {i: found.get(i, (0, i)) for i, _ in rows}


def test_vectors_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(pivots, "CHUNK", 40)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + rng.normal(size=16) * 0.12).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(30)] + [(2000 + i, [3 * x for x in rows[5][1]]) for i in range(3)]
    rows += [(3000, None), (3001, [0.0] * 16), (3002, [float("nan")] * 16), (3003, [1.0, None]), (3004, []),
             (3005, [float("inf")] + [1.0] * 15), (3006, [1.0, 2.0]), (3007, [1.0, 2.1]), (3008, [1e300] * 16)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("size", F.lit(1))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in pivots.link_vectors(table).collect()}
    wanted = all_pairs(rows)
    assert sum(n for n, _ in got.values()) >= 0.95 * sum(n for n, _ in wanted.values())
    assert all(n <= wanted[i][0] for i, (n, _) in got.items())
    assert {i for i in got if got[i][0] == 0 and i >= 3000} == {i for i in wanted if wanted[i][0] == 0 and i >= 3000}
    assert np.mean([got[i][1] == wanted[i][1] for i in wanted]) > 0.95
    assert pivots.link_vectors(table.limit(0)).count() == 0
    null = spark.createDataFrame([(None, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert tuple(pivots.link_vectors(null).first()) == (None, 0, None, True)


def test_recall_on_the_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in pivots.op5_pivots(spark, folder).collect()}
    wanted = all_pairs(rows)
    assert set(got) == set(wanted)
    assert sum(n for n, _ in got.values()) >= 0.9 * sum(n for n, _ in wanted.values())


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 150), (300, 301)]
    table = spark.createDataFrame(edges * 2, "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(table).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[i] for i in [*range(100, 160), 200]} == {100} and got[301] == 300
    assert components.components(table.limit(0)).count() == 0


# --------------------------------------------------------------------------------------- URLs


def test_hosts_paths_and_rules(spark):
    cases = [
        ("http://WWW.Example.com/en/a?x#y", "www.example.com", "/en/a", "www.example.com/en/", "allow"),
        ("https://blog.example.com/en/1", "blog.example.com", "/en/1", "example.com/en/", "block"),
        ("https://example.com/EN/1", "example.com", "/EN/1", "com/", "allow"),
        ("http://a.net/es/", "a.net", "/es/", "net/es/", "block"), ("http://a.net/esx", "a.net", "/esx", None, None),
        ("http://x.com", "x.com", "", None, None), ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        ("nothing", "", "", None, None), (None, "", "", None, None), ("", "", "", None, None),
        ("http://a.org#x?y/z", "a.org", "", None, None), ("s://h://i/j", "h:", "//i/j", None, None),
    ]
    table = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "page_id long, url string").withColumn("rule", F.lit(1))
    got = {r["page_id"]: r for r in url_filter.judge(table, url_filter.labelled_urls(spark)).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == verdict if verdict else got[i]["verdict"] in ("allow", "block")
    assert url_filter.judge(table.limit(0), url_filter.labelled_urls(spark)).count() == 0


def test_url_model(spark):
    labelled = url_filter.labelled_urls(spark)
    fitted = url_filter.judge(labelled, labelled, rules=())
    assert fitted.filter("(score >= 0.5) <> (block = 1)").count() == 0
    fresh = spark.createDataFrame(
        [("http://m.cheap-pills.example.org/fr/8", "block"), ("https://free-bets.example.net/x", "block"),
         ("http://garden.example.org/en/4", "allow"), ("https://www.thion.example.org/de/99", "allow")],
        "url string, wanted string",
    )
    assert url_filter.judge(fresh, labelled, rules=()).filter("verdict <> wanted").count() == 0
    assert url_filter.judge(fresh, labelled.limit(0), rules=()).count() == 4


# ----------------------------------------------------------------------------------- pipeline


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "quality rules", "MinHash near-dedup", "mixing sources to target weights", "BPE encoding and decoding"]
    kept = docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in kept.select("doc_id").collect()}
        kept = function(spark, kept, folder).cache()
        assert kept.columns == docs.columns
        after = {r["doc_id"] for r in kept.select("doc_id").collect()}
        assert after <= before
        clean = {i for i in before if i in labels and labels[i]["quality"] == 1 and labels[i]["toxic"] == 0}
        if name in ("toxicity", "quality rules"):
            assert len(clean & after) >= 0.9 * len(clean)
    text = {r["doc_id"]: r["text"] for r in kept.collect()}
    rows = corpus_pipeline.STAGES[-1][1](spark, kept, folder).collect()
    own = bpe.loaded(open(bpe.default_tokenizer(), encoding="utf-8").read())
    assert len(rows) == kept.count()
    for r in rows[:50]:
        assert own.decode(np.array(r["ids"], dtype="<u4").tobytes()) == text[r["doc_id"]]


def test_pipeline_of_nothing(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, folder)
        assert docs.count() == 0


def test_every_operator_is_registered_once():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    numbers = sorted(int(n[2:].split("_")[0]) for n in names if n[2].isdigit())
    assert numbers == list(range(1, 11)) and "pipeline" in __spark_entry__.queries()
