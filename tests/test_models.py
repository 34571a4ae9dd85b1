"""Models and attributions: invariants."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit import settings
from panelkit.catalog import models as Q
from panelkit.operators import attribution as E
from panelkit.operators import models as L
from panelkit.operators import boosting, trees
from panelkit.plans.features import trade_features

FEATURES = ["a", "b", "c", "d"]
KEY = ("day_num",)


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(7)
    x = draw.normal(size=(600, 4))
    y = np.maximum(0, np.round(np.exp(0.5 * x[:, 0]) + x[:, 1] * (x[:, 2] > 0)))
    return spark.createDataFrame(
        [(i, float(y[i]), *map(float, x[i])) for i in range(600)],
        "day_num int, sales double, a double, b double, c double, d double",
    ).persist()


@pytest.fixture(scope="module")
def fitted(rows):
    train, val = rows.filter("day_num < 450"), rows.filter("day_num >= 450")
    return L.fit_all({
        "tweedie": lambda: L.fit_tweedie(train, FEATURES),
        "boosted": lambda: L.fit_boosted(train, val, FEATURES, rounds=8, patience=2, depth=4, step=0.3),
        "forest": lambda: L.fit_forest(train, FEATURES, trees=6, depth=4),
        "broken": lambda: 1 / 0,
    })


def test_a_broken_model_does_not_stop_the_others(fitted):
    assert set(fitted) == set(L.MODELS)


def test_best_round_within_rounds(fitted):
    assert 1 <= int(fitted["boosted"].info["best_round"]) <= 8


@pytest.mark.parametrize("name", L.MODELS)
def test_contributions_add_up_to_the_prediction(rows, fitted, name):
    one = fitted[name]
    told = E.explain(one, rows, KEY)
    raw = one.model.transform(rows)
    scale = F.col("prediction") if name == "forest" else F.log("prediction")
    joined = told.join(raw.select("day_num", scale.alias("raw")), "day_num")
    worst = joined.agg(F.max(F.abs(F.col("raw") - F.col("prediction")))).first()[0]
    assert worst < 1e-6


def _random_ensemble(draw, n_trees, depth, features):
    """Random trees; features may repeat on a path."""
    nodes = {k: [] for k in ("tree", "feature", "threshold", "left", "right", "value", "cover", "gain")}

    def add(tree, level, cover):
        at = len(nodes["tree"])
        leaf = level == depth or (level > 1 and draw.random() < 0.2)
        for k, v in (("tree", tree), ("feature", int(draw.integers(features))), ("threshold", draw.normal()), ("left", at),
                     ("right", at), ("value", draw.normal() if leaf else 0.0), ("cover", cover), ("gain", 1.0)):
            nodes[k].append(v)
        if not leaf:
            part = draw.uniform(0.05, 0.95)
            nodes["left"][at] = add(tree, level + 1, cover * part)
            nodes["right"][at] = add(tree, level + 1, cover * (1 - part))
        return at

    for t in range(n_trees):
        add(t, 0, 100.0)
    return trees.TreeEnsemble(**{k: np.array(v) for k, v in nodes.items()}, base=0.25)


def _worth(one, root, x, known):
    """Expected value of a tree where only the features in `known` are known."""
    if one.is_leaf[root]:
        return one.value[root]
    f, sides = one.feature[root], (one.left[root], one.right[root])
    if f in known:
        return _worth(one, sides[0] if x[f] <= one.threshold[root] else sides[1], x, known)
    return sum(one.cover[s] / one.cover[root] * _worth(one, s, x, known) for s in sides)


@pytest.mark.parametrize("depth", [1, 2, 5, 8])
def test_contributions_equal_enumerated_coalitions(depth):
    from itertools import combinations
    draw = np.random.default_rng(depth)
    n = 5
    one = _random_ensemble(draw, 3, depth, n)
    x = draw.normal(size=(6, n))
    x[0, 0] = np.nan
    got = one.contributions(x)
    assert np.allclose(one.expected + got.sum(axis=1), one.margins(x), atol=1e-10)
    for r in range(len(x)):
        def worth(known, row=x[r]):
            return sum(_worth(one, root, row, known) for root in one.roots)
        for i in range(n):
            others = [j for j in range(n) if j != i]
            expected = sum(
                math.factorial(k) * math.factorial(n - 1 - k) / math.factorial(n) * (worth({*s, i}) - worth(set(s)))
                for k in range(n) for s in combinations(others, k)
            )
            assert math.isclose(got[r, i], expected, abs_tol=1e-10)


def test_a_large_ensemble_is_prepared_in_seconds():
    import time
    one = _random_ensemble(np.random.default_rng(3), 120, 8, 60)
    start = time.process_time()
    assert len(one.paths) == 120
    assert time.process_time() - start < 5
    x = np.random.default_rng(4).normal(size=(20, 60))
    assert np.allclose(one.expected + one.contributions(x).sum(axis=1), one.margins(x), atol=1e-6)


def test_loss_falls_every_round_and_the_best_prefix_is_kept(rows, monkeypatch):
    train, val = rows.filter("day_num < 450"), rows.filter("day_num >= 450")
    monkeypatch.setattr(boosting, "KEPT_ROUNDS", 4)

    def fit(rounds, held):
        return boosting.fit(train, held, FEATURES, "sales", rounds, 3, 4, 0.4, seed=5)

    stopped = fit(60, val)
    assert all(b < a for a, b in zip(stopped.train_loss, stopped.train_loss[1:]))
    losses = stopped.validation_loss
    assert stopped.best_round == max(1, int(np.argmin(losses))) and stopped.rounds < 60
    assert len(losses) - 1 == stopped.rounds == stopped.best_round + 3
    short = fit(stopped.best_round, None)
    assert short.rounds == stopped.best_round == len(stopped.trees.roots)
    assert np.array_equal(short.trees.value, stopped.trees.value) and np.array_equal(short.trees.threshold, stopped.trees.threshold)


def test_boosting_follows_the_definition(rows):
    """One full-depth round on all rows equals a split searched by hand and its Newton steps."""
    data = rows.orderBy("day_num").toPandas()
    x, y = data[FEATURES].to_numpy(), data["sales"].to_numpy()
    base = math.log(y.mean())
    g, h = boosting.Tweedie(1.1).derivatives(y, np.full(len(y), base))
    best = (0.0, None)
    edges = boosting.bin_edges(rows, FEATURES)
    for f in range(4):
        for cut in edges[f]:
            lo = x[:, f] <= cut
            if h[lo].sum() >= 1 and h[~lo].sum() >= 1:
                gain = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (lo, ~lo)) - g.sum() ** 2 / (h.sum() + 1)
                best = max(best, (gain, (f, cut)), key=lambda b: b[0])
    got = boosting.fit(rows, None, FEATURES, "sales", 1, 1, 1, 0.1, fraction=1.0)
    one = got.trees
    assert (one.feature[0], one.threshold[0]) == best[1] and math.isclose(one.gain[0], best[0], rel_tol=1e-9)
    for side, mask in ((1, x[:, best[1][0]] <= best[1][1]), (2, x[:, best[1][0]] > best[1][1])):
        assert math.isclose(one.value[side], -0.1 * g[mask].sum() / (h[mask].sum() + 1), rel_tol=1e-9)
        assert one.cover[side] == mask.sum()
    after = boosting.Tweedie(1.1).loss(y, one.margins(x)).mean()
    assert math.isclose(got.train_loss[1], after, rel_tol=1e-9)


def test_predictions_and_reports(rows, fitted):
    val = rows.filter("day_num >= 450").withColumn("sales_lag_28", F.lit(1.0))
    predictions = L.predict_all(fitted, val, ("day_num", "sales", "sales_lag_28"))
    assert predictions.filter("prediction < 0").count() == 0
    assert predictions.count() == 3 * 150
    sample = L.sample_predictions(predictions, 10, key=KEY)
    assert sample.count() == 10 and sample.collect() == L.sample_predictions(predictions, 10, key=KEY).collect()
    ranked = L.importances(fitted["boosted"], 3).collect()
    assert [r["rank"] for r in ranked] == [1, 2, 3] and ranked[0]["relative"] == 1.0


def test_summary_orders_and_limits(rows, fitted):
    summary = E.summarize(E.explain(fitted["boosted"], rows, KEY), top=2)
    for r in summary.limit(50).collect():
        ups = [c["impact"] for c in r["top_positive"]]
        downs = [c["impact"] for c in r["top_negative"]]
        assert len(ups) <= 2 and ups == sorted(ups, reverse=True) and all(u >= 0 for u in ups)
        assert len(downs) <= 2 and downs == sorted(downs) and all(d <= 0 for d in downs)
    bars = E.waterfall(summary, KEY).filter("day_num = 0").orderBy("position").collect()
    assert [b["impact"] for b in bars] == sorted(b["impact"] for b in bars)
    importance = E.global_importance(E.explain(fitted["boosted"], rows, KEY), key=KEY).orderBy("rank").collect()
    assert [r["feature"] for r in importance][:1] and len(importance) == 4


@pytest.mark.parametrize("name", ["forest", "boosted"])
def test_save_and_load(rows, fitted, tmp_path, name):
    one = fitted[name]
    L.save(one, str(tmp_path / "m"))
    again = L.load(name, str(tmp_path / "m"), one.features)
    a, b = (L.predict(m, rows, KEY).orderBy("day_num").collect() for m in (one, again))
    assert a == b


def test_the_bound_on_rows_does_not_cut_the_features(spark, folder):
    got = Q._table(spark, folder)
    whole = trade_features(spark, folder)
    last = whole.agg(F.max("day_num")).first()[0]
    assert got.agg(F.min("day_num"), F.max("day_num")).first() == (last - Q.FIT_DAYS + 1, last)
    day = F.col("day_num") == last - 40
    reach = ("sales_expanding_mean", "zero_streak", "days_since_sale", "sell_price")
    key = settings.SERIES_KEY
    a, b = (
        {(r[0], r[1]): tuple(r[2:]) for r in t.filter(day).fillna(0, reach).select(*key, *reach).collect()}
        for t in (got, whole)
    )
    assert a == b and any(x[1] > Q.FIT_DAYS for x in a.values())
    train = L.drop_warm_up(whole).filter("split = 'train'")
    wanted = dict(train.groupBy("store_id").agg(F.avg("sales")).collect())
    means = got.select("store_id", "store_avg_sales").distinct().collect()
    assert all(r[1] == pytest.approx(wanted[r[0]]) for r in means) and len(means) == len(wanted)


def test_the_tree_queries_fit_at_the_defaults(spark, folder, monkeypatch):
    monkeypatch.setattr(Q, "_cache", {})
    monkeypatch.setattr(Q, "_rows", lambda spark, folder, split: split)
    monkeypatch.setattr(L, "fit_forest", lambda *rows, **changed: (rows, changed))
    monkeypatch.setattr(L, "fit_boosted", lambda *rows, **changed: (rows, changed))
    assert Q._forest(spark, folder) == (("train",), {})
    assert Q._boosted(spark, folder) == (("train", "val"), {})


def test_leaky_features_are_off_by_default():
    assert not set(settings.LEAKY_FEATURES) & set(L.tree_features())
    assert set(settings.LEAKY_FEATURES) <= set(L.tree_features(leaky=True))
    assert len(settings.FEATURE_COLUMNS) == 80
