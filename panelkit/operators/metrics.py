"""Forecast errors, and comparing models by them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.columns import at_least_zero


def forecast_errors(
    df: DataFrame,
    by: Sequence[str] = ("model",),
    actual: str = "sales",
    predicted: str = "prediction",
    naive: str = "sales_lag_28",
    digits: int | None = 4,
) -> DataFrame:
    """RMSE, MAE and RMSSE per group, from sums that are taken in one pass.

    RMSSE is the RMSE over that of the seasonal-naive forecast on the same rows, where a missing
    naive value counts as 0; it is infinite where the naive forecast has no error. Predictions are
    clipped at 0.
    """
    y, p = F.col(actual), at_least_zero(F.col(predicted))
    n = F.coalesce(F.col(naive), F.lit(0))
    sums = df.groupBy(*by).agg(
        F.sqrt(F.avg(F.pow(y - p, 2))).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.sqrt(F.avg(F.pow(y - n, 2))).alias("naive_rmse"),
    )
    scaled = F.when(F.col("naive_rmse") > 0, F.try_divide("rmse", "naive_rmse")).otherwise(
        F.lit(float("inf"))
    )
    out = sums.withColumn("rmsse", scaled).withColumn("beats_naive_pct", (1 - F.col("rmsse")) * 100)
    if digits is None:
        return out
    return out.withColumns({c: F.bround(c, digits) for c in out.columns if c not in by})


def metrics_by_model(metrics: DataFrame, models: Sequence[str], model: str = "model") -> DataFrame:
    """One row per metric, one column per model."""
    long = metrics.select(
        model, F.col("rmse").alias("RMSE"), F.col("mae").alias("MAE"), F.col("rmsse").alias("RMSSE")
    ).unpivot([model], ["RMSE", "MAE", "RMSSE"], "metric", "value")
    return long.groupBy("metric").pivot(model, list(models)).agg(F.first("value"))


def best_model(metrics: DataFrame, model: str = "model", error: str = "rmse") -> DataFrame:
    """The model with the smallest error; equal errors are settled by name."""
    return metrics.agg(
        F.min_by(model, F.struct(error, model)).alias("best_model"), F.min(error).alias("best_rmse")
    )
