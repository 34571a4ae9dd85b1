"""Inventory rules, rounding, percentiles, metrics, intents and retrieval on small cases."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.functions import columns as C
from panelkit.catalog import analytics
from panelkit.functions.percentile import exact_percentiles
from panelkit.functions.text import bigrams, words
from panelkit.operators import answers as Q
from panelkit.operators import inventory as I
from panelkit.operators import metrics as M
from panelkit.operators import panel as P
from panelkit.operators import retrieval as R
from panelkit.operators import split as S


@pytest.mark.parametrize("stock, order, status, urgency", [
    (None, 272, "unknown", "info"), (300.0, 0, "adequate", "normal"), (180.0, 92, "adequate", "normal"),
    (50.0, 222, "low", "moderate"), (20.0, 252, "critical", "urgent"),
])
def test_recommendation(spark, stock, order, status, urgency):
    df = spark.createDataFrame([(250.0, 5.0, stock)], "forecasted_demand double, demand_std double, current_stock double")
    row = I.recommend(df).first()
    assert row["safety_stock"] == 21.76 and row["reorder_point"] == 84.26
    assert (row["recommended_order_qty"], row["stock_status"], row["urgency"]) == (order, status, urgency)
    assert row["reasoning"].startswith("8.9 units a day, 250 in 28 days, are forecast.")


def test_stock_as_of(spark):
    """Counts of the forecast day and later are unknown; equal days take the larger, null counts are none."""
    counts = spark.createDataFrame([
        ("s", "a", 1, 5.0), ("s", "a", 3, 7.0), ("s", "a", 3, 9.0), ("s", "a", 4, None), ("s", "a", 5, 1.0),
        ("s", "b", 9, 2.0), ("s", "c", None, 2.0), ("s", "d", 2, 0.0),
    ], "store_id string, item_id string, day_num int, current_stock double")
    days = spark.createDataFrame([("s", i, 5) for i in "abcd"], "store_id string, item_id string, day_num int")
    got = {r.item_id: (r.current_stock, r.counted_on) for r in I.stock_as_of(counts, days).collect()}
    assert got == {"a": (9.0, 3), "d": (0.0, 2)}
    assert I.stock_as_of(counts.limit(0), days).count() == I.stock_as_of(counts, days.limit(0)).count() == 0
    predicted = days.select("store_id", "item_id", F.lit(2.0).alias("predicted_sales"))
    rows = I.inventory_requests(predicted, predicted.select("store_id", "item_id", F.lit(1.0).alias("demand_std")),
                                I.stock_as_of(counts, days).withColumn("lead_time_days", F.lit(2)))
    got = {r.item_id: (r.stock_status, r.lead_time_days) for r in rows.collect()}
    assert got == {"a": ("adequate", 2), "b": ("unknown", 7), "c": ("unknown", 7), "d": ("critical", 2)}


def test_lower_service_level(spark):
    df = spark.range(1).select(I.safety_stock(F.lit(5.0), 7, 0.90).alias("s"))
    assert df.first()["s"] == 16.93


def test_days_of_supply(spark):
    df = spark.createDataFrame(
        [(220.0, 10.0), (140.0, 10.0), (70.0, 10.0), (30.0, 10.0), (29.0, 10.0), (0.0, 10.0), (5.0, 0.0), (None, 1.0)],
        "current_stock double, daily_rate double",
    )
    tiers = [r["supply_tier"] for r in I.with_days_of_supply(df).collect()]
    assert tiers == ["adequate", "low", "medium", "high", "critical", "urgent", "adequate", "unknown"]
    slow = spark.createDataFrame([(0.1, 1.0, 0.01)], "forecasted_demand double, demand_std double, current_stock double")
    row = I.with_days_of_supply(I.recommend(slow)).first()
    assert row["supply_tier"] == "critical" and math.isclose(row["days_of_supply"], 2.8)


def test_rounding_and_labels(spark):
    row = spark.range(1).select(
        C.half_even(F.lit(2.5), 0).alias("even"), C.shorten(F.lit("x" * 26)).alias("cut"),
        C.numbers_in(F.lit("FOODS_3 sold 12.5 of 7.")).alias("numbers"),
        C.day_number(F.lit("d_123")).alias("day"), C.at_least_zero(F.lit(-1.0)).alias("zero"),
        C.feature_group(F.lit("sales_lag_7")).alias("lag"), C.feature_group(F.lit("sales_vs_store_avg")).alias("ctx"),
    ).first()
    assert row["even"] == 2.0 and row["cut"] == "x" * 22 + "..." and row["numbers"] == [3.0, 12.5, 7.0]
    assert row["day"] == 123 and row["zero"] == 0.0
    assert (row["lag"], row["ctx"]) == ("Lag", "Contextual")


@pytest.mark.parametrize("seed, size, accuracy", [
    (0, 500, 100), (1, 500, 1000), (2, 700, 1199), (3, 1, 100), (4, 7, 10), (5, 33, 50), (6, 60, 100),
])
def test_percentiles_equal_sorting(spark, seed, size, accuracy):
    draw = np.random.default_rng(seed)
    values = np.concatenate([draw.normal(size=size), np.full(size * 4 // 5, 1.0), draw.integers(0, 5, size * 3 // 5)])
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    wanted = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.9, "e": 1.0}
    for ranked in (20, 10_000):
        got = exact_percentiles(df, "x", wanted, accuracy, ranked).first()
        for name, q in wanted.items():
            assert math.isclose(got[name], float(np.quantile(values, q)), rel_tol=1e-12)


def test_percentiles_of_nothing(spark):
    none = spark.createDataFrame([(None,)], "x double")
    assert exact_percentiles(none, "x", {"a": 0.5}).first()["a"] is None


def test_rank_cuts_read_their_input_once(spark, folder):
    plan = analytics.underperformers(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Window" not in plan


def test_metrics(spark):
    df = spark.createDataFrame(
        [("m", 1.0, 2.0, 3.0), ("m", 3.0, -1.0, None), ("z", 0.0, 0.0, 0.0)],
        "model string, sales double, prediction double, sales_lag_28 double",
    )
    rows = {r["model"]: r for r in M.forecast_errors(df, digits=None).collect()}
    assert math.isclose(rows["m"]["rmse"], math.sqrt((1 + 9) / 2))
    assert math.isclose(rows["m"]["mae"], 2.0)
    assert math.isclose(rows["m"]["rmsse"], math.sqrt(10 / 2) / math.sqrt((4 + 9) / 2))
    assert rows["z"]["rmsse"] == float("inf")
    best = M.best_model(M.forecast_errors(df)).first()
    assert best["best_model"] == "z"


@pytest.mark.parametrize("question, wanted", [
    ("Which products need restocking?", "restock"), ("What is safety stock?", "restock"),
    ("Show me underperforming products", "underperforming"), ("Why would sales increase?", "explanation"),
    ("What is the RMSE?", "kpi"), ("Which store performs best?", "store_comparison"),
    ("How long is the lead time?", "inventory_knowledge"), ("trending items", "top"), ("hello", "general"),
])
def test_intents(spark, question, wanted):
    assert spark.range(1).select(Q.intent(F.lit(question)).alias("i")).first()["i"] == wanted


def test_answers_name_products_of_their_own_documents(spark):
    questions = spark.createDataFrame(
        [("why", "Why would sales drop?"), ("top", "trending items"), ("bare", "popular items"),
         ("lone", "why?"), ("fixed", "What to restock?")], "question_id string, question string")

    def said(store, item, predicted, average):
        given = {"store_id": store, "item_id": item, "predicted_sales": predicted, "avg_sales": average}
        return {k: v for k, v in given.items() if v}

    retrieved = spark.createDataFrame([
        ("why", 2, 0.5, "forecast", "f", said("S1", "I1", "3.26", "2.04")),
        ("why", 3, 0.4, "forecast", "f", said("S2", "I2", "9.0", "8.0")),
        ("why", 1, 0.6, "business_knowledge", "SNAP", None),
        ("top", 1, 0.9, "forecast", "f", said("S1", "I1", "1.0", None)),
        ("top", 2, 0.8, "forecast", "f", said("S1", "I2", "4.0", "3.0")),
        ("top", 3, 0.7, "forecast", "f", said("S1", "I3", "0.0", "3.0")),
        ("top", 4, 0.6, "underperformer", "u", said("S1", "I9", None, "99.0")),
        ("bare", 1, 0.9, "top_performer", "t", said("S3", "I4", None, "7.0")),
        ("bare", 2, 0.8, "catalog", "c", said("S3", "I4", None, "7.0")),
        ("bare", 3, 0.7, "underperformer", "u", said("S3", "I5", None, "8.0")),
    ], "question_id string, rank int, score double, type string, content string, metadata map<string,string>")
    fixed = spark.createDataFrame([("restock", "all of it")], "intent string, answer string")
    got = {r["question_id"]: r["answer"] for r in Q.answer_questions(questions, retrieved, fixed).collect()}
    assert got["why"].splitlines()[-1] == "For example, I1 @ S1: predicted 3.3 units/day, historical average 2.0"
    assert "Benefit days" in got["why"] and "I2" not in got["why"]
    assert got["top"].splitlines() == [
        "Highest predicted demand:", "I2 @ S1: predicted 4.0 units/day, historical average 3.0",
        "I1 @ S1: predicted 1.0 units/day", "Demand of these over 28 days: 140 units"]
    assert got["bare"].splitlines() == ["Best average sales:", "I4 @ S3: historical average 7.0"]
    assert got["lone"].splitlines() == list(Q.DEFAULT_DRIVERS)
    assert got["fixed"] == "all of it"
    plain = Q.answer_questions(questions, retrieved.drop("metadata"), fixed)
    assert plain.filter("answer is null").count() == 0


def test_explained_answers(spark):
    """The flag decides; unknown series, null flags and unanswered questions keep what they have."""
    questions = spark.createDataFrame([
        ("q1", "Why?", "s", "a", True), ("q2", "Why?", "s", "a", False), ("q3", "Why?", "s", "z", True),
        ("q4", "Why?", None, "a", True), ("q5", "Why?", "s", "a", None), ("q6", "Why?", "s", "b", True),
    ], "question_id string, question string, store_id string, item_id string, explain boolean")
    asked = {r.question_id: r.question for r in Q.expand_flagged(questions).collect()}
    assert asked == {
        "q1": "Why? store s product a", "q2": "Why?", "q3": "Why? store s product z", "q4": "Why? product a",
        "q5": "Why?", "q6": "Why? store s product b",
    }
    answers = questions.select("question_id", F.lit("Because.").alias("answer"))
    told = spark.createDataFrame([("s", "a", "Told."), ("s", "b", None)], "store_id string, item_id string, interpretation string")
    got = {r.question_id: (r.answer, r.enriched) for r in Q.explain_answers(answers, questions, told).collect()}
    plain = ("Because.", False)
    assert got == {"q1": ("Because.\n\nTold.", True), **{f"q{i}": plain for i in range(2, 7)}}


def test_words_and_bigrams(spark):
    row = spark.range(1).select(words(F.lit("The Élan of x sales, sales!")).alias("w")).select(
        "w", bigrams(F.col("w")).alias("b")
    ).first()
    assert row["w"] == ["élan", "sales", "sales"]
    assert row["b"] == ["élan sales", "sales sales"]
    assert spark.range(1).select(bigrams(words(F.lit(""))).alias("b")).first()["b"] == []


def _dense_scores(texts, query):
    """Cosine scores by plain Python."""
    def terms(t):
        w = [x for x in t.lower().split()]
        return w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]
    counts = [{t: terms(x).count(t) for t in set(terms(x))} for x in texts]
    idf = {t: math.log((1 + len(texts)) / (1 + sum(t in c for c in counts))) + 1 for c in counts for t in c}
    def vector(c):
        v = {t: (1 + math.log(n)) * idf[t] for t, n in c.items() if t in idf}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {t: x / norm for t, x in v.items()}
    q = vector({t: terms(query).count(t) for t in set(terms(query))})
    return [sum(x * q.get(t, 0.0) for t, x in vector(c).items()) for c in counts]


def test_retrieval_equals_dense_scores(spark):
    texts = ["green tea green", "black tea", "green apple pie", "apple tree", "tea tea tea"]
    docs = spark.createDataFrame(
        [(f"d{i}", t, "odd" if i % 2 else "even") for i, t in enumerate(texts)], "id string, content string, type string"
    )
    questions = spark.createDataFrame([("q", "green tea"), ("none", "zzz")], "question_id string, question string")
    got = {r["id"]: r["score"] for r in R.retrieve(questions, docs, 5).collect()}
    wanted = {f"d{i}": s for i, s in enumerate(_dense_scores(texts, "green tea")) if s > 0.01}
    assert got.keys() == wanted.keys()
    assert all(math.isclose(got[k], wanted[k], rel_tol=1e-9) for k in wanted)
    kind = R.retrieve(questions, docs, 5, doc_type="odd").collect()
    assert {r["id"] for r in kind} == {"d1"}


def test_stratified_sample(spark):
    df = spark.createDataFrame(
        [(f"c{k}", f"i{k}_{j}") for k, n in enumerate((3, 40, 400)) for j in range(n)] * 2, "cat_id string, item_id string"
    )
    counts = {r["cat_id"]: r["n_sampled"] for r in P.sampled_per_category(P.sample_items(df)).collect()}
    assert counts == {"c0": 3, "c1": 9, "c2": 90}
    assert sorted(P.sample_items(df).collect()) == sorted(P.sample_items(df.repartition(7)).collect())


def test_split_and_warm_up(spark):
    df = spark.createDataFrame(
        [(d, None if d < 3 else 1.0) for d in range(1, 41)], "day_num int, sales_lag_7 double"
    )
    marked = S.mark_split(df)
    assert marked.filter("split = 'val'").count() == 28
    kept = S.drop_warm_up(marked)
    assert kept.count() == 38
    assert S.drop_warm_up(S.mark_split(df, 40)).count() == 40
