"""Training and validation rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit import settings


def mark_split(
    df: DataFrame, validation_days: int = settings.VALIDATION_DAYS, order: str = settings.ORDER
) -> DataFrame:
    """`split`: 'val' on the newest days, 'train' before."""
    newest = df.agg(F.max(order)).scalar()
    return df.withColumn(
        "split", F.when(F.col(order) >= newest - (validation_days - 1), "val").otherwise("train")
    )


def warm_up_columns(df: DataFrame) -> list[str]:
    """Columns that are null at the start of a series: names with `lag_` or `r7_`."""
    return [c for c in df.columns if "lag_" in c or "r7_" in c]


def drop_warm_up(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop training rows with a null look-back; validation rows all stay."""
    columns = warm_up_columns(df) if columns is None else columns
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    return df.filter((F.col("split") == "val") | complete)


def fill_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna(0, list(columns))
