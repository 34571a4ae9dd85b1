"""Queries: inventory rules on naive forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.catalog import sql
from panelkit.catalog.analytics import _metrics_sql, _naive_predictions
from panelkit.operators import analytics as A
from panelkit.operators import features as X
from panelkit.operators import inventory as I
from panelkit.operators import metrics as M
from panelkit.sources import trade
from panelkit.storage import stage


def _requests(spark, folder):
    """Every series with its last 28-day mean as forecast, and a made stock position.

    The stock is the last week's sales, unknown for the items of one category.
    """
    rows = X.add_series_columns(
        trade.dense_sales(spark, folder), X.rolling_mean((28,)), X.lags((1, 7))
    )
    latest = A.latest_rows(rows).select(
        "store_id", "item_id",
        F.col("sales_r28_mean").alias("predicted_sales"),
        F.when(F.col("cat_id") != "CAT_2", (F.col("sales_lag_1") + F.col("sales_lag_7")) * 4.0)
        .alias("current_stock"),
        (F.col("sales_lag_7") % 10 + 1).cast("int").alias("lead_time_days"),
        F.when(F.col("cat_id") == "CAT_1", 0.9).otherwise(0.95).alias("service_level"),
    )
    return latest, A.demand_deviation(rows)


def _recommendations(spark, folder):
    return I.inventory_requests(*_requests(spark, folder))


def _positions(spark, folder, forecast_days):
    """Stock as of the day before each forecast, lead time and service level of every series.

    Made counts: on every day with sales, a multiple of the units sold; one category is never counted.
    """
    counts = trade.sales_cells(spark, folder).filter(F.col("cat_id") != "CAT_2").select(
        "store_id", "item_id", "day_num",
        (F.col("sales") * 4.0 * (F.col("day_num") % 5 + 1)).alias("current_stock"),
    )
    number = F.substring_index("item_id", "#", -1).cast("int")
    return forecast_days.select(
        "store_id", "item_id", (number % 10 + 1).alias("lead_time_days"),
        F.when(number % 3 == 1, 0.9).otherwise(0.95).alias("service_level"),
    ).join(I.stock_as_of(counts, forecast_days), ["store_id", "item_id"], "left")


def inventory_as_of(spark, folder):
    """Recommendations of the last day from the latest count before it."""
    rows = X.add_series_columns(trade.dense_sales(spark, folder), X.rolling_mean((28,)))
    latest = stage(A.latest_rows(rows).select(
        "store_id", "item_id", "day_num", F.col("sales_r28_mean").alias("predicted_sales")
    ), "latest")
    out = I.inventory_requests(
        latest.drop("day_num"), A.demand_deviation(rows), _positions(spark, folder, latest)
    )
    return out.select(
        "store_id", "item_id", "current_stock", "counted_on", "lead_time_days", "service_level",
        "safety_stock", "reorder_point", "recommended_order_qty", "stock_status", "urgency",
    )


def safety_stock(spark, folder):
    return _recommendations(spark, folder).select(
        "store_id", "item_id", "service_level", "lead_time_days", "safety_stock"
    )


def reorder_point(spark, folder):
    return _recommendations(spark, folder).select(
        "store_id", "item_id", "daily_demand", "reorder_point"
    )


def order_quantity(spark, folder):
    return _recommendations(spark, folder).select("store_id", "item_id", "recommended_order_qty")


def stock_status(spark, folder):
    return _recommendations(spark, folder).select("store_id", "item_id", "stock_status", "urgency")


def days_of_supply(spark, folder):
    out = I.with_days_of_supply(_recommendations(spark, folder))
    return out.select("store_id", "item_id", F.bround("days_of_supply", 4).alias("days_of_supply"), "supply_tier")


def order_reasoning(spark, folder):
    return _recommendations(spark, folder).select("store_id", "item_id", "reasoning")


def inventory_recommendations(spark, folder):
    """The flagship: order lines to a recommendation for every series."""
    return _recommendations(spark, folder).select(
        "store_id", "item_id", "daily_forecast", "forecasted_demand", "daily_demand",
        "safety_stock", "reorder_point", "recommended_order_qty",
        F.coalesce("current_stock", F.lit(-1.0)).alias("current_stock"),
        "stock_status", "urgency", "lead_time_days", "service_level",
    )


def forecast_context(spark, folder):
    """Forecast, history and metrics of three naive models for every series."""
    dense = stage(trade.dense_sales(spark, folder), "dense")
    predictions = _naive_predictions(spark, folder, dense)
    metrics = M.forecast_errors(predictions)
    latest = A.latest_rows(
        predictions.select("store_id", "item_id", "day_num", "model", F.col("prediction").alias("predicted_sales")),
        key=("store_id", "item_id", "model"),
    )
    history = A.history(dense)
    return I.forecast_rows(latest, history, metrics)


QUERIES = {
    f.__name__: f
    for f in (
        safety_stock, reorder_point, order_quantity, stock_status, days_of_supply,
        order_reasoning, inventory_recommendations, inventory_as_of, forecast_context,
    )
}

_P = "(PARTITION BY store_id, item_id ORDER BY day_num"
_INVENTORY = f"""
looked AS (
  SELECT *, avg(sales) OVER {_P} ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS predicted,
         lag(sales, 1) OVER {_P}) AS lag1, lag(sales, 7) OVER {_P}) AS lag7
  FROM dense
),
requests AS (
  SELECT store_id, item_id, predicted,
         CASE WHEN cat_id <> 'CAT_2' THEN CAST((lag1 + lag7) * 4 AS DOUBLE) END AS stock,
         CAST(lag7 % 10 + 1 AS INTEGER) AS lead,
         CAST(CASE WHEN cat_id = 'CAT_1' THEN 0.9 ELSE 0.95 END AS DOUBLE) AS level
  FROM looked WHERE day_num = (SELECT max(day_num) FROM days)
),
deviations AS (SELECT store_id, item_id, stddev_samp(sales) AS demand_std FROM dense GROUP BY 1, 2),
stocked AS (
  SELECT *, predicted * 28 AS forecast, predicted * 28 / 28 AS daily,
         round_even(CASE WHEN level >= 0.95 THEN 1.645::DOUBLE ELSE 1.28::DOUBLE END * demand_std * sqrt(CAST(lead AS DOUBLE)), 2) AS safety
  FROM requests JOIN deviations USING (store_id, item_id)
),
recommended AS (
  SELECT *, daily * lead + safety AS point,
         greatest(0, round_even(forecast + safety - coalesce(stock, 0), 0)) AS qty,
         CASE WHEN stock IS NULL THEN 'unknown' WHEN stock < safety THEN 'critical'
              WHEN stock < daily * lead + safety THEN 'low' ELSE 'adequate' END AS stock_status,
         CASE WHEN stock IS NULL THEN 'info' WHEN stock < safety THEN 'urgent'
              WHEN stock < daily * lead + safety THEN 'moderate' ELSE 'normal' END AS urgency
  FROM stocked
)"""


def _fixed(x: str, digits: int) -> str:
    return f"CAST(CAST(round_even({x}, {digits}) AS DECIMAL(28, {digits})) AS VARCHAR)"


def _sql(body: str) -> str:
    return sql.dense("").rstrip() + f",{_INVENTORY}\n{body}"


# The same rules on the latest count before the last day, and lead times and levels by item.
_AS_OF = _INVENTORY.replace("requests AS (", """counted AS (
  SELECT store_id, item_id, max(day_num) AS counted_on, arg_max(sales * 4.0::DOUBLE * (day_num % 5 + 1), day_num) AS stock
  FROM dense WHERE sales > 0 AND cat_id <> 'CAT_2' AND day_num < (SELECT max(day_num) FROM days) GROUP BY 1, 2
),
requests AS (""").replace("CASE WHEN cat_id <> 'CAT_2' THEN CAST((lag1 + lag7) * 4 AS DOUBLE) END AS stock", "stock, counted_on").replace(
    "lag7 % 10 + 1 AS INTEGER", "CAST(split_part(item_id, '#', 2) AS INTEGER) % 10 + 1 AS INTEGER"
).replace("FROM looked WHERE", "FROM looked LEFT JOIN counted USING (store_id, item_id) WHERE")

ORACLES = {
    "inventory_as_of": sql.dense("").rstrip() + f""",{_AS_OF}
SELECT store_id, item_id, stock AS current_stock, counted_on, lead AS lead_time_days, level AS service_level,
       safety AS safety_stock, round_even(point, 2) AS reorder_point, qty AS recommended_order_qty, stock_status, urgency
FROM recommended""",
    "safety_stock": _sql("""
SELECT store_id, item_id, level AS service_level, lead AS lead_time_days, safety AS safety_stock FROM recommended"""),
    "reorder_point": _sql("""
SELECT store_id, item_id, round_even(daily, 2) AS daily_demand, round_even(point, 2) AS reorder_point FROM recommended"""),
    "order_quantity": _sql("SELECT store_id, item_id, qty AS recommended_order_qty FROM recommended"),
    "stock_status": _sql("SELECT store_id, item_id, stock_status, urgency FROM recommended"),
    "days_of_supply": _sql("""
SELECT store_id, item_id, round_even(stock / nullif(daily, 0), 4) AS days_of_supply,
       CASE WHEN stock IS NULL THEN 'unknown' WHEN stock <= 0 THEN 'urgent'
            WHEN daily = 0 OR stock / daily > 21 THEN 'adequate'
            WHEN stock / daily >= 14 THEN 'low' WHEN stock / daily >= 7 THEN 'medium'
            WHEN stock / daily >= 3 THEN 'high' ELSE 'critical' END AS supply_tier
FROM recommended"""),
    "order_reasoning": _sql(f"""
SELECT store_id, item_id,
  {_fixed('daily', 1)} || ' units a day, ' || {_fixed('forecast', 0)} || ' in 28 days, are forecast. A delivery takes '
  || CAST(lead AS VARCHAR) || ' days; to be served in ' || {_fixed('level * 100', 0)}
  || '% of cases although demand deviates by ' || {_fixed('demand_std', 2)} || ', ' || {_fixed('safety', 0)}
  || ' units are kept in reserve. ' ||
  CASE WHEN stock IS NULL THEN 'What is in stock is not known.'
       ELSE {_fixed('stock', 0)} ||
            CASE WHEN stock_status <> 'adequate' THEN ' in stock do not cover the lead time: order now.'
                 ELSE ' in stock are enough for now.' END END AS reasoning
FROM recommended"""),
    "inventory_recommendations": _sql("""
SELECT store_id, item_id, round_even(predicted, 4) AS daily_forecast, round_even(forecast, 2) AS forecasted_demand,
       round_even(daily, 2) AS daily_demand, safety AS safety_stock, round_even(point, 2) AS reorder_point,
       qty AS recommended_order_qty, coalesce(stock, -1) AS current_stock, stock_status, urgency,
       lead AS lead_time_days, level AS service_level
FROM recommended"""),
    "forecast_context": _metrics_sql("""
SELECT store_id, item_id, p.model, round_even(greatest(0, prediction), 4) AS predicted_daily_sales,
       round_even(greatest(0, prediction) * 28, 2) AS predicted_period_sales, 28 AS forecast_days,
       round_even(mean, 2) AS mean_daily_sales, round_even(std, 2) AS std_daily_sales,
       CAST(top AS DOUBLE) AS max_daily_sales, n AS data_points, rmse, mae, rmsse
FROM predictions p JOIN metrics USING (model)
JOIN (SELECT store_id, item_id, avg(sales) AS mean, stddev_pop(sales) AS std, max(sales) AS top, count(*) AS n
      FROM dense GROUP BY 1, 2) USING (store_id, item_id)
WHERE day_num = (SELECT max(day_num) FROM days)"""),
}
