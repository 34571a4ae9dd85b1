"""Look-back columns on a series worked by hand, in one piece and in blocks."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from panelkit.operators import features as X
from panelkit.operators import panel as P

SALES = [0, 3, 0, 0, 5, 2, 0, 0, 0, 4]
LAG1 = [None, 0, 3, 0, 0, 5, 2, 0, 0, 0]
MEAN3 = [None, 0, 1.5, 1, 1, 1.6667, 2.3333, 2.3333, 0.6667, 0]
STD3 = [0, 0, 2.1213, 1.7321, 1.7321, 2.8868, 2.5166, 2.5166, 1.1547, 0]
MIN3 = [None, 0, 0, 0, 0, 0, 0, 0, 0, 0]
MAX3 = [None, 0, 3, 3, 3, 5, 5, 5, 2, 0]
MEDIAN3 = [None, 0, 1.5, 0, 0, 0, 2, 2, 0, 0]
EXPANDING = [None, 0, 1.5, 1, 0.75, 1.6, 1.6667, 1.4286, 1.25, 1.1111]
STREAK = [0, 1, 0, 1, 2, 0, 0, 1, 2, 3]
SINCE = [999, 999, 999, 999, 3, 1, 999, 999, 999, 4]


def _near(got, wanted):
    assert len(got) == len(wanted)
    for g, w in zip(got, wanted, strict=True):
        assert (g is None) == (w is None)
        assert g is None or math.isclose(g, w, abs_tol=1e-4)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [("s", "i", d, v) for d, v in enumerate(SALES)],
        "store_id string, item_id string, day_num int, sales long",
    )


@pytest.mark.parametrize("block", [None, 3, 4, 7])
def test_worked_series(rows, block):
    out = X.add_series_columns(
        rows, X.lags((1,)), X.rolling_mean((3,)), X.rolling_std((3,)), X.rolling_min((3,)),
        X.rolling_max((3,)), X.rolling_median((3,)), X.expanding_mean(), X.zero_streak(),
        X.days_since_sale(), series=X.Series(block_days=block), halo=3,
    ).orderBy("day_num").toPandas().astype(object)
    out = out.where(out.notna(), None)
    for column, wanted in {
        "sales_lag_1": LAG1, "sales_r3_mean": MEAN3, "sales_r3_std": STD3, "sales_r3_min": MIN3,
        "sales_r3_max": MAX3, "sales_r3_median": MEDIAN3, "sales_expanding_mean": EXPANDING,
        "zero_streak": STREAK, "days_since_sale": SINCE,
    }.items():
        _near(list(out[column]), wanted)


def test_block_shorter_than_look_back(rows):
    with pytest.raises(ValueError):
        X.add_series_columns(rows, X.lags(), series=X.Series(block_days=10))


def test_no_look_ahead(spark, rows):
    changed = rows.withColumn("sales", F.when(F.col("day_num") == 6, 99).otherwise(F.col("sales")))
    builders = (X.lags((1, 2)), X.rolling_mean((3,)), X.rolling_std((3,)), X.expanding_mean(), X.zero_streak())
    a, b = (
        X.add_series_columns(df, *builders).filter("day_num <= 6").drop("sales").orderBy("day_num").collect()
        for df in (rows, changed)
    )
    assert a == b


def test_one_exchange_for_all_columns(rows):
    plan = X.add_series_columns(rows.repartition(3), *X.sales_builders()[:7], X.zero_streak())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Sort [") == 1


def test_price_edges(spark):
    df = spark.createDataFrame(
        [("s", "i", d, 1, p) for d, p in enumerate([0.0, 2.0, 3.0])],
        "store_id string, item_id string, day_num int, sales long, sell_price double",
    )
    out = X.add_series_columns(df, X.price_changes(), X.discount(), X.price_momentum(1)).orderBy("day_num").collect()
    assert [r["price_change"] for r in out] == [None, 2.0, 1.0]
    assert [r["price_change_pct"] for r in out] == [0.0, 0.0, 0.5]
    assert [r["discount"] for r in out] == [0.0, 0.0, 0.5]
    assert [r["price_momentum"] for r in out] == [0.0, 0.0, 0.5]


def test_densify(spark):
    cells = spark.createDataFrame(
        [("s", "a", "d", "c", "t", 2, 5), ("s", "a", "d", "c", "t", 4, 1), ("s", "b", "d", "c", "t", 1, 7)],
        "store_id string, item_id string, dept_id string, cat_id string, state_id string, day_num int, sales long",
    )
    got = {
        (r["item_id"], r["day_num"]): r["sales"] for r in P.densify(cells, 2, 5).collect()
    }
    assert got == {
        ("a", 2): 5, ("a", 3): 0, ("a", 4): 1, ("a", 5): 0,
        ("b", 2): 0, ("b", 3): 0, ("b", 4): 0, ("b", 5): 0,
    }


def test_melt_and_last_days(spark):
    wide = spark.createDataFrame(
        [("x", "i", "d", "c", "s", "t", 1, 2, 3)],
        "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, "
        "d_9 int, d_10 int, d_11 int",
    )
    assert [(r["day_num"], r["sales"]) for r in P.melt_days(wide).collect()] == [(9, 1), (10, 2), (11, 3)]
    assert [r["day_num"] for r in P.melt_days(wide, last_days=2).collect()] == [10, 11]


def test_prices_fall_back_to_median_then_zero(spark):
    df = spark.createDataFrame(
        [("s", "a", 1, 2.0), ("s", "a", 2, None), ("s", "a", 3, 4.0), ("s", "b", 1, None)],
        "store_id string, item_id string, day_num int, sell_price double",
    )
    got = {(r["item_id"], r["day_num"]): r["sell_price"] for r in P.fill_prices(df).collect()}
    assert got == {("a", 1): 2.0, ("a", 2): 3.0, ("a", 3): 4.0, ("b", 1): 0.0}


def test_codes_follow_sorted_values(spark):
    df = spark.createDataFrame(
        [("b", "y", None), ("a", "x", "k"), ("c", "x", "k")], "store_id string, item_id string, dept_id string"
    )
    from panelkit.functions.ranking import value_codes

    codes = value_codes(df, ["store_id", "item_id", "dept_id"])
    out = X.encode(df, ["store_id", "item_id", "dept_id"], codes).orderBy("store_id").collect()
    assert [tuple(r[f"{c}_enc"] for c in ("store_id", "item_id", "dept_id")) for r in out] == [
        (0, 0, 0), (1, 1, -1), (2, 0, 0)
    ]
