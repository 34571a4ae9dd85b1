"""Schema checks, duplicates, and a profile of the panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit import settings


def schema_violations(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Missing columns and columns of another type, one row each."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for field in expected.fields:
        want = field.dataType.simpleString()
        got = actual.get(field.name)
        if got != want:
            rows.append((field.name, want, got, "missing" if got is None else "type"))
    return df.sparkSession.createDataFrame(
        rows, "column string, expected string, actual string, problem string"
    )


def required_value_violations(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows with a null per required column, in one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.unpivot([], list(required), "column", "null_rows")


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def conflicting_keys(
    df: DataFrame, key: Sequence[str] = (*settings.SERIES_KEY, settings.ORDER)
) -> DataFrame:
    """Keys that still repeat once exact duplicates are gone."""
    return (
        drop_exact_duplicates(df).groupBy(*key).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")
    )


def panel_profile(
    df: DataFrame,
    value: str = settings.VALUE,
    price: str = settings.PRICE,
    date: str = "date",
    item: str = "item_id",
    store: str = "store_id",
) -> DataFrame:
    """Rows, date range, value range, distinct items and stores, missing prices."""
    # Distinct counts go through one row per (store, item) so no single row set is expanded.
    per_series = df.groupBy(store, item).agg(
        F.count("*").alias("n"), F.min(date).alias("d0"), F.max(date).alias("d1"),
        F.min(value).alias("v0"), F.max(value).alias("v1"),
        F.count_if(F.col(price).isNull()).alias("p0"),
    )
    return per_series.agg(
        F.sum("n").alias("n_rows"),
        F.min("d0").alias("first_date"),
        F.max("d1").alias("last_date"),
        F.min("v0").alias("min_sales"),
        F.max("v1").alias("max_sales"),
        F.countDistinct(item).alias("n_items"),
        F.countDistinct(store).alias("n_stores"),
        F.sum("p0").alias("null_prices"),
    )
