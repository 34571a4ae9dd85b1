"""Queries: aggregates, rankings, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit import settings
from panelkit.catalog import sql
from panelkit.functions.columns import (
    at_least_zero, feature_group, half_even, shorten,
)
from panelkit.functions.percentile import exact_percentiles
from panelkit.operators import analytics as A
from panelkit.operators import features as X
from panelkit.operators import metrics as M
from panelkit.operators import split as S
from panelkit.sources import trade
from panelkit.storage import stage


def _round(df, **digits):
    return df.withColumns({c: F.bround(c, n) for c, n in digits.items()})


def sales_overview(spark, folder):
    return A.overview(trade.panel(spark, folder))


def store_summary(spark, folder):
    return A.group_summary(trade.panel(spark, folder), "store_id")


def category_summary(spark, folder):
    return A.group_summary(trade.panel(spark, folder), "cat_id")


def summary_map(spark, folder):
    """The store summary as one map, opened again into its sorted keys and totals."""
    summary = A.group_summary(trade.panel(spark, folder), "store_id")
    mapped = A.as_map(summary, "store_id", ["total_sales", "n_products"])
    return mapped.select(F.explode("by_key").alias("store_id", "stats")).select(
        "store_id", "stats.total_sales", "stats.n_products"
    )


def catalog_profile(spark, folder):
    return _round(A.catalog_profile(trade.panel(spark, folder)), avg_sales=8, avg_price=4, zero_pct=6)


def store_pattern(spark, folder):
    return _round(A.store_pattern(trade.dense_sales(spark, folder)), avg_daily=6)


def category_pattern(spark, folder):
    return _round(A.category_pattern(trade.panel(spark, folder)), avg_daily=6, avg_price=4)


def ranked_stores(spark, folder):
    return _round(A.ranked_stores(trade.dense_sales(spark, folder)), avg_daily=6)


def _averages(spark, folder):
    return A.series_average(trade.dense_sales(spark, folder))


def average_percentiles(spark, folder):
    """Exact deciles of the series averages, and of the quantities of single order lines."""
    wanted = {"p10": 0.1, "p50": 0.5, "p90": 0.9}
    averages = exact_percentiles(stage(_averages(spark, folder), "averages"), "avg_sales", wanted)
    prices = exact_percentiles(trade.table(spark, folder, "lineitem"), "l_extendedprice", wanted)
    both = averages.withColumn("of", F.lit("avg_sales")).unionByName(
        prices.withColumn("of", F.lit("l_extendedprice"))
    )
    return _round(both, p10=6, p50=6, p90=6)


def underperformers(spark, folder):
    return _round(A.underperformers(_averages(spark, folder)), avg_sales=8)


def top_performers(spark, folder):
    return _round(A.top_performers(_averages(spark, folder)), avg_sales=8)


def underperformer_list(spark, folder):
    return A.underperformer_list(_averages(spark, folder), n=10)


def underperformer_list_one_store(spark, folder):
    return A.underperformer_list(_averages(spark, folder), n=5, store="ASIA_1", share=0.5)


def product_actions(spark, folder):
    """The action for every series; averages taken over order lines per day to reach all actions."""
    rates = _averages(spark, folder).withColumn("avg_sales", F.col("avg_sales") / 10)
    return _round(A.with_action(rates), avg_sales=8)


def slowest_per_store(spark, folder):
    slow = A.slowest_per_store(A.underperformers(_averages(spark, folder)))
    return slow.select("store_id", F.explode("slowest").alias("s")).select(
        "store_id", "s.rank", "s.item_id", F.bround("s.avg_sales", 8).alias("avg_sales")
    )


def sales_history(spark, folder):
    return _round(
        A.history(trade.dense_sales(spark, folder)), mean_daily_sales=8, std_daily_sales=6
    )


def demand_deviation(spark, folder):
    return _round(A.demand_deviation(trade.dense_sales(spark, folder)), demand_std=6)


def target_snapshot(spark, folder):
    return _round(A.target_snapshot(trade.dense_sales(spark, folder)), mean=6, std=6, zero_pct=6)


def top_by_total_sales(spark, folder):
    return A.top_products(trade.panel(spark, folder), 10, "total_sales")


def top_by_average(spark, folder):
    return A.top_products(trade.panel(spark, folder), 10, "avg_daily")


def top_by_revenue(spark, folder):
    return A.top_products(trade.panel(spark, folder), 10, "revenue")


def items_of_top_50(spark, folder):
    return A.ranked_items(A.top_products(trade.panel(spark, folder), 50))


def latest_rows(spark, folder):
    return A.latest_rows(trade.panel(spark, folder)).select(
        "store_id", "item_id", "day_num", "date", "sales", "sell_price"
    )


def one_series(spark, folder):
    return A.one_series(trade.panel(spark, folder), "ASIA_1", "Brand#7").select(
        "store_id", "item_id", "day_num", "sales", "sell_price"
    )


def forecast_bars(spark, folder):
    """Chart rows per series, with the last 28-day mean as the prediction."""
    rows = X.add_series_columns(trade.dense_sales(spark, folder), X.rolling_mean((28,)))
    latest = A.latest_rows(rows).select(
        "store_id", "item_id", at_least_zero(F.col("sales_r28_mean")).alias("predicted_daily_sales")
    )
    joined = latest.join(A.history(rows), ["store_id", "item_id"])
    return _round(A.forecast_bars(joined), value=9)


def feature_groups(spark, folder):
    """Rows of the model features by group, weighted by the number of sold cells of the panel."""
    cells = trade.sales_cells(spark, folder)
    n = cells.agg(F.count("*")).scalar()
    names = spark.createDataFrame([(f,) for f in settings.FEATURE_COLUMNS], "feature string")
    counts = A.feature_group_counts(names)
    return counts.withColumn("n_values", F.col("n_features") * n)


def short_labels(spark, folder):
    """Part names cut to chart labels, behind their brand and type."""
    parts = trade.table(spark, folder, "part")
    label = F.concat_ws(" / ", "p_brand", "p_type", "p_name")
    return parts.select(
        "p_partkey", shorten(label).alias("label"), feature_group(F.lower(label)).alias("group_of")
    )


def rounded_balances(spark, folder):
    """Rounding half to even, and clipping at zero."""
    return trade.table(spark, folder, "customer").select(
        "c_custkey",
        half_even(F.col("c_acctbal") / 8, 1).alias("eighth"),
        at_least_zero(F.col("c_acctbal")).alias("owed"),
    )


# What the naive forecasts stand in for here is a model: metrics work on any prediction.
NAIVE_MODELS = ("last_day", "last_week", "mean_28")


def _naive_predictions(spark, folder, panel=None):
    dense = trade.dense_sales(spark, folder) if panel is None else panel
    rows = X.add_series_columns(dense, X.lags((1, 7, 28)), X.rolling_mean((28,)))
    validation = S.mark_split(rows).filter(F.col("split") == "val")
    return validation.select(
        "store_id", "item_id", "day_num", "sales", "sales_lag_28",
        F.col("sales_lag_1").cast("double").alias("last_day"),
        F.col("sales_lag_7").cast("double").alias("last_week"),
        F.col("sales_r28_mean").alias("mean_28"),
    ).unpivot(
        ["store_id", "item_id", "day_num", "sales", "sales_lag_28"], list(NAIVE_MODELS),
        "model", "prediction",
    )


def forecast_errors(spark, folder):
    return M.forecast_errors(_naive_predictions(spark, folder))


def forecast_errors_by_store(spark, folder):
    return M.forecast_errors(_naive_predictions(spark, folder), by=("model", "store_id"))


def metrics_by_model(spark, folder):
    return M.metrics_by_model(M.forecast_errors(_naive_predictions(spark, folder)), NAIVE_MODELS)


def best_model(spark, folder):
    return M.best_model(M.forecast_errors(_naive_predictions(spark, folder)))


QUERIES = {
    f.__name__: f
    for f in (
        sales_overview, store_summary, category_summary, summary_map, catalog_profile,
        store_pattern, category_pattern, ranked_stores, average_percentiles, underperformers,
        top_performers, underperformer_list, underperformer_list_one_store, product_actions,
        slowest_per_store, sales_history, demand_deviation, target_snapshot,
        top_by_total_sales, top_by_average, top_by_revenue, items_of_top_50, latest_rows,
        one_series, forecast_bars, feature_groups, short_labels, rounded_balances,
        forecast_errors, forecast_errors_by_store, metrics_by_model, best_model,
    )
}

# ------------------------------------------------------------------------------------ SQL

_SUMMARY = """
SELECT {by}, CAST(sum(sales) AS BIGINT) AS total_sales, round_even(avg(sales), 2) AS avg_daily_sales,
       round_even(avg(sell_price), 2) AS avg_price, count(DISTINCT item_id) AS n_products
FROM panel GROUP BY 1"""
_AVERAGES = "averages AS (SELECT store_id, item_id, avg(sales) AS avg_sales FROM dense GROUP BY 1, 2)"


def _averages_sql(body: str) -> str:
    return sql.dense("").rstrip() + f",\n{_AVERAGES}\n{body}"


def _action(x: str) -> str:
    return f"""CASE WHEN {x} < 0.2 THEN 'delist' WHEN {x} < 0.5 THEN 'promote' ELSE 'monitor' END AS action,
       CASE WHEN {x} < 0.2 THEN 'Sells less than once in five days; its shelf space would serve another product better.'
            WHEN {x} < 0.5 THEN 'Sells less than once in two days; a lower price or a better spot may be tried first.'
            ELSE 'Sells at least once in two days; look again after a few weeks.' END AS reasoning"""


def _group_of(x: str) -> str:
    from panelkit.functions.columns import FEATURE_GROUPS, OTHER_GROUP

    cases = " ".join(
        "WHEN " + " OR ".join(f"contains({x}, '{w}')" for w in words) + f" THEN '{label}'"
        for label, words in FEATURE_GROUPS
    )
    return f"CASE {cases} ELSE '{OTHER_GROUP}' END"


def _top(metric: str, name: str, n: int) -> str:
    return f"""
SELECT item_id, store_id, {metric} AS {name} FROM panel GROUP BY 1, 2
ORDER BY {name} DESC, item_id, store_id LIMIT {n}"""


_LABEL = "p_brand || ' / ' || p_type || ' / ' || p_name"
_P = "(PARTITION BY store_id, item_id ORDER BY day_num"
_PREDICTIONS = f"""
looked AS (
  SELECT store_id, item_id, day_num, sales, lag(sales, 28) OVER {_P}) AS naive,
         CAST(lag(sales, 1) OVER {_P}) AS DOUBLE) AS last_day,
         CAST(lag(sales, 7) OVER {_P}) AS DOUBLE) AS last_week,
         avg(sales) OVER {_P} ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS mean_28
  FROM dense
),
predictions AS (
  UNPIVOT (SELECT * FROM looked WHERE day_num > (SELECT max(day_num) FROM dense) - 28)
  ON last_day, last_week, mean_28 INTO NAME model VALUE prediction
)"""


def _errors(by: str) -> str:
    return f"""
errors AS (
  SELECT {by}, sqrt(avg(pow(sales - greatest(0, prediction), 2))) AS rmse,
         avg(abs(sales - greatest(0, prediction))) AS mae,
         sqrt(avg(pow(sales - coalesce(naive, 0), 2))) AS naive_rmse
  FROM predictions GROUP BY ALL
),
metrics AS (
  SELECT {by}, round_even(rmse, 4) AS rmse, round_even(mae, 4) AS mae, round_even(naive_rmse, 4) AS naive_rmse,
         round_even(rmse / naive_rmse, 4) AS rmsse, round_even((1 - rmse / naive_rmse) * 100, 4) AS beats_naive_pct
  FROM errors
)"""


def _metrics_sql(body: str, by: str = "model") -> str:
    return sql.dense("").rstrip() + f",{_PREDICTIONS},{_errors(by)}\n{body}"


ORACLES = {
    "sales_overview": sql.panel("""
SELECT CAST(sum(sales) AS BIGINT) AS total_sales, round_even(sum(sales * sell_price), 2) AS total_revenue,
       round_even(avg(sales), 2) AS avg_daily_sales, count(DISTINCT item_id) AS unique_products,
       count(DISTINCT store_id) AS unique_stores,
       round_even(avg(CASE WHEN sales = 0 THEN 1 ELSE 0 END) * 100, 1) AS zero_sales_pct,
       CAST(min(date) AS VARCHAR) || ' to ' || CAST(max(date) AS VARCHAR) AS date_range,
       count(*) AS total_data_points
FROM panel"""),
    "store_summary": sql.panel(_SUMMARY.format(by="store_id")),
    "category_summary": sql.panel(_SUMMARY.format(by="cat_id")),
    "summary_map": sql.panel("""
SELECT store_id, CAST(sum(sales) AS BIGINT) AS total_sales, count(DISTINCT item_id) AS n_products
FROM panel GROUP BY 1"""),
    "catalog_profile": sql.panel("""
SELECT store_id, item_id, dept_id, cat_id, state_id, round_even(avg(sales), 8) AS avg_sales,
       CAST(sum(sales) AS BIGINT) AS total_sales, round_even(coalesce(avg(sell_price), 0), 4) AS avg_price,
       max(sales) AS max_sales, round_even(avg(CASE WHEN sales = 0 THEN 1 ELSE 0 END) * 100, 6) AS zero_pct,
       count(sales) AS days_observed
FROM panel GROUP BY ALL"""),
    "store_pattern": sql.dense("""
SELECT store_id, CAST(sum(sales) AS BIGINT) AS total_sales, round_even(avg(sales), 6) AS avg_daily,
       max(sales) AS best_day FROM dense GROUP BY 1"""),
    "category_pattern": sql.panel("""
SELECT cat_id, CAST(sum(sales) AS BIGINT) AS total_sales, round_even(avg(sales), 6) AS avg_daily,
       count(DISTINCT item_id) AS n_products, round_even(avg(sell_price), 4) AS avg_price
FROM panel GROUP BY 1"""),
    "ranked_stores": sql.dense("""
SELECT store_id, CAST(sum(sales) AS BIGINT) AS total_sales, round_even(avg(sales), 6) AS avg_daily,
       max(sales) AS best_day FROM dense GROUP BY 1 ORDER BY total_sales DESC, store_id"""),
    "average_percentiles": _averages_sql("""
SELECT 'avg_sales' AS "of", round_even(quantile_cont(avg_sales, 0.1), 6) AS p10,
       round_even(quantile_cont(avg_sales, 0.5), 6) AS p50, round_even(quantile_cont(avg_sales, 0.9), 6) AS p90
FROM averages
UNION ALL
SELECT 'l_extendedprice', round_even(quantile_cont(l_extendedprice, 0.1), 6),
       round_even(quantile_cont(l_extendedprice, 0.5), 6), round_even(quantile_cont(l_extendedprice, 0.9), 6)
FROM lineitem"""),
    "underperformers": _averages_sql("""
SELECT store_id, item_id, round_even(avg_sales, 8) AS avg_sales FROM averages
WHERE avg_sales <= (SELECT quantile_cont(avg_sales, 0.1) FROM averages)"""),
    "top_performers": _averages_sql("""
SELECT store_id, item_id, round_even(avg_sales, 8) AS avg_sales FROM averages
WHERE avg_sales >= (SELECT quantile_cont(avg_sales, 0.9) FROM averages)"""),
    "underperformer_list": _averages_sql(f"""
SELECT store_id, item_id, round_even(avg_sales, 3) AS avg_daily_sales, {_action('avg_sales')}
FROM (SELECT * FROM averages WHERE avg_sales <= (SELECT quantile_cont(avg_sales, 0.1) FROM averages)
      ORDER BY avg_sales, store_id, item_id LIMIT 10)"""),
    "underperformer_list_one_store": _averages_sql(f"""
SELECT store_id, item_id, round_even(avg_sales, 3) AS avg_daily_sales, {_action('avg_sales')}
FROM (SELECT * FROM averages WHERE avg_sales <= (SELECT quantile_cont(avg_sales, 0.5) FROM averages)
      AND store_id = 'ASIA_1' ORDER BY avg_sales, store_id, item_id LIMIT 5)"""),
    "product_actions": _averages_sql(f"""
SELECT store_id, item_id, round_even(avg_sales / 10, 8) AS avg_sales, {_action('avg_sales / 10')}
FROM averages"""),
    "slowest_per_store": _averages_sql("""
SELECT store_id, CAST(rank AS INTEGER) AS rank, item_id, round_even(avg_sales, 8) AS avg_sales FROM (
  SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY avg_sales, item_id) AS rank
  FROM averages WHERE avg_sales <= (SELECT quantile_cont(avg_sales, 0.1) FROM averages))
WHERE rank <= 5"""),
    "sales_history": sql.dense("""
SELECT store_id, item_id, round_even(avg(sales), 8) AS mean_daily_sales,
       round_even(stddev_pop(sales), 6) AS std_daily_sales, max(sales) AS max_daily_sales,
       count(*) AS data_points
FROM dense GROUP BY 1, 2"""),
    "demand_deviation": sql.dense("""
SELECT store_id, item_id, round_even(stddev_samp(sales), 6) AS demand_std FROM dense GROUP BY 1, 2"""),
    "target_snapshot": sql.dense("""
SELECT round_even(avg(sales), 6) AS mean, round_even(stddev_samp(sales), 6) AS std, min(sales) AS min,
       max(sales) AS max, round_even(avg(CASE WHEN sales = 0 THEN 1 ELSE 0 END) * 100, 6) AS zero_pct
FROM dense"""),
    "top_by_total_sales": sql.panel(_top("CAST(sum(sales) AS BIGINT)", "total_sales", 10)),
    "top_by_average": sql.panel(
        f"SELECT * REPLACE (round_even(avg_daily_sales, 2) AS avg_daily_sales) FROM ("
        f"{_top('avg(sales)', 'avg_daily_sales', 10)})"
    ),
    "top_by_revenue": sql.panel(
        f"SELECT * REPLACE (round_even(total_revenue, 2) AS total_revenue) FROM ("
        f"{_top('sum(sales * sell_price)', 'total_revenue', 10)})"
    ),
    "items_of_top_50": sql.panel(f"SELECT DISTINCT item_id FROM ({_top('sum(sales)', 'total_sales', 50)})"),
    "latest_rows": sql.panel("""
SELECT store_id, item_id, day_num, date, sales, sell_price FROM panel
WHERE day_num = (SELECT max(day_num) FROM days)"""),
    "one_series": sql.panel("""
SELECT store_id, item_id, day_num, sales, sell_price FROM panel
WHERE store_id = 'ASIA_1' AND item_id = 'Brand#7'"""),
    "forecast_bars": sql.dense("").rstrip() + """,
stats AS (
  SELECT store_id, item_id, avg(sales) AS "Hist. Mean",
         avg(sales) FILTER (day_num < hi AND day_num >= hi - 28) AS "Predicted",
         CAST(max(sales) AS DOUBLE) AS "Hist. Max"
  FROM dense, (SELECT max(day_num) AS hi FROM days) GROUP BY 1, 2
)
SELECT store_id, item_id, name, round_even(value, 9) AS value
FROM (UNPIVOT stats ON "Hist. Mean", "Predicted", "Hist. Max" INTO NAME name VALUE value)""",
    "feature_groups": sql.cells(f"""
SELECT feature_type, count(*) AS n_features, count(*) * (SELECT count(*) FROM cells) AS n_values
FROM (SELECT {_group_of('feature')} AS feature_type
      FROM (SELECT unnest([{', '.join(f"'{c}'" for c in settings.FEATURE_COLUMNS)}]) AS feature))
GROUP BY 1"""),
    "short_labels": f"""
SELECT p_partkey, CASE WHEN length({_LABEL}) > 25 THEN substr({_LABEL}, 1, 22) || '...' ELSE {_LABEL} END AS label,
       {_group_of(f'lower({_LABEL})')} AS group_of
FROM part""",
    "rounded_balances": """
SELECT c_custkey, round_even(c_acctbal / 8, 1) AS eighth, greatest(0, c_acctbal) AS owed FROM customer""",
    "forecast_errors": _metrics_sql("SELECT * FROM metrics"),
    "forecast_errors_by_store": _metrics_sql("SELECT * FROM metrics", "model, store_id"),
    "metrics_by_model": _metrics_sql("""
SELECT metric, max(value) FILTER (model = 'last_day') AS last_day,
       max(value) FILTER (model = 'last_week') AS last_week, max(value) FILTER (model = 'mean_28') AS mean_28
FROM (SELECT model, 'RMSE' AS metric, rmse AS value FROM metrics
      UNION ALL SELECT model, 'MAE', mae FROM metrics UNION ALL SELECT model, 'RMSSE', rmsse FROM metrics)
GROUP BY 1"""),
    "best_model": _metrics_sql("""
SELECT model AS best_model, rmse AS best_rmse FROM metrics ORDER BY rmse, model LIMIT 1"""),
}
