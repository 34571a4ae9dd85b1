"""Sentences about stores, items, categories and forecasts, as documents to search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions.columns import fixed_text


def _say(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _whole(name: str) -> Column:
    return F.col(name).cast("long").cast("string")


def _document(df: DataFrame, kind: str, id_parts: list[str], content: Column, meta: list[str], prefix=None):
    metadata = F.create_map(*[x for c in meta for x in (F.lit(c), F.col(c).cast("string"))])
    return df.select(
        F.concat_ws("_", F.lit(prefix or kind), *id_parts).alias("id"),
        content.alias("content"), F.lit(kind).alias("type"), metadata.alias("metadata"),
    )


def catalog_documents(profile: DataFrame) -> DataFrame:
    c = F.col
    return _document(profile, "catalog", ["store_id", "item_id"], _say(
        "Item ", c("item_id"), " of ", c("dept_id"), " / ", c("cat_id"), ", sold at ", c("store_id"),
        ", ", c("state_id"), ": ", fixed_text(c("avg_sales"), 2), " units a day on average, ",
        _whole("max_sales"), " on its best day and ", _whole("total_sales"), " altogether over ",
        _whole("days_observed"), " days, of which ", fixed_text(c("zero_pct"), 1),
        "% were without a sale. It costs $", fixed_text(c("avg_price"), 2), " on average.",
    ), ["store_id", "item_id", "cat_id", "avg_sales"])


def forecast_documents(forecasts: DataFrame) -> DataFrame:
    """`forecasts`: series, category, state, model, its rmse, `predicted_sales`, and `avg_sales` where known."""
    c = F.col
    known = [x for x in ("avg_sales",) if x in forecasts.columns]
    return _document(forecasts, "forecast", ["store_id", "item_id"], _say(
        c("model"), " expects ", c("item_id"), " (", c("cat_id"), ") to sell ",
        fixed_text(c("predicted_sales"), 2), " units a day at ", c("store_id"), ", ", c("state_id"),
        ". This forecast has a validation RMSE of ", fixed_text(c("rmse"), 4), ".",
    ), ["store_id", "item_id", "predicted_sales", "model", *known])


def store_documents(pattern: DataFrame) -> DataFrame:
    return _document(pattern, "store_pattern", ["store_id"], _say(
        F.col("store_id"), " is a store that sold ", _whole("total_sales"), " units: ",
        fixed_text(F.col("avg_daily"), 2), " per product and day, ", _whole("best_day"),
        " of one product on the best day.",
    ), ["store_id"])


def category_documents(pattern: DataFrame) -> DataFrame:
    return _document(pattern, "category_pattern", ["cat_id"], _say(
        F.col("cat_id"), " is a category of ", _whole("n_products"), " items that sold ",
        _whole("total_sales"), " units, ", fixed_text(F.col("avg_daily"), 2),
        " per product and day, at a mean price of $", fixed_text(F.col("avg_price"), 2), ".",
    ), ["cat_id"], prefix="cat_pattern")


def underperformer_documents(slow: DataFrame) -> DataFrame:
    return _document(slow, "underperformer", ["store_id", "item_id"], _say(
        F.col("item_id"), " underperforms at ", F.col("store_id"), ": with ",
        fixed_text(F.col("avg_sales"), 2),
        " units a day it is in the slowest tenth, where a lower price, a promotion or its place is in question.",
    ), ["store_id", "item_id", "avg_sales"])


def top_performer_documents(fast: DataFrame) -> DataFrame:
    return _document(fast, "top_performer", ["store_id", "item_id"], _say(
        F.col("item_id"), " is a top product at ", F.col("store_id"), ": with ",
        fixed_text(F.col("avg_sales"), 2), " units a day it is in the fastest tenth and must not run out.",
    ), ["store_id", "item_id", "avg_sales"])


# What every shop should know: (id, subject, text).
KNOWLEDGE = (
    ("biz_kpi_rmse", "RMSE",
     "RMSE is the root mean square error of a forecast. Lower is better, and large errors weigh more than in MAE."),
    ("biz_safety_stock", "safety_stock",
     "Safety stock is the service factor times the demand deviation times the square root of the lead time. "
     "The factor is 1.645 for 95% service and 1.28 for 90%."),
    ("biz_reorder_point", "reorder_point",
     "Reorder Point is daily demand times lead time, plus safety stock. Below it a new order is due."),
    ("biz_tweedie", "tweedie_loss",
     "Tweedie loss suits sales with many zero days; a variance power of 1.1 lies close to Poisson."),
    ("biz_snap", "SNAP",
     "SNAP benefits are paid on set days of the month in each state, and food sales rise on those days."),
    ("biz_rmsse", "RMSSE",
     "RMSSE scales the error by that of a seasonal naive forecast. Below 1 the model beats the naive forecast."),
    ("biz_shap", "SHAP",
     "SHAP splits a prediction into one contribution per feature; positive ones raise it, negative ones lower it."),
    ("biz_lag_features", "lag_features",
     "Lag features are past sales: lag 1 is yesterday, lag 7 the same weekday, lag 28 four weeks ago. "
     "Rolling price and sales statistics capture trend and volatility."),
)


def knowledge_documents(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(
        [(i, t, subject) for i, subject, t in KNOWLEDGE], "id string, content string, concept string"
    )
    return rows.select(
        "id", "content", F.lit("business_knowledge").alias("type"),
        F.create_map(F.lit("concept"), "concept").alias("metadata"),
    )


def union_documents(*parts: DataFrame) -> DataFrame:
    """All kinds of documents in one table."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
