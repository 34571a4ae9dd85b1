"""Global positions over sorted distinct values, without sorting them in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.storage import stage


def value_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, code): each column's distinct values numbered from 0 in sorted order.

    Values are range-partitioned, numbered inside their range, and shifted by the sizes of the
    ranges before. The range of a value is written with it, so that both passes over the values
    agree whatever is lost or re-run in between. The codes are written too: Catalyst then knows
    their size and broadcasts them only where that is small. Nulls get no code here.
    """
    values = (
        df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in columns
        ])).alias("v"))
        .select("v.*")
        .filter(F.col("value").isNotNull())
        .distinct()
    )
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(
        values.repartitionByRange(parts, "column", "value").withColumn(
            "_range", F.spark_partition_id()
        ),
        "value_ranges",
    )
    sizes = ranged.groupBy("column", "_range").agg(F.count("*").alias("_n"))
    before = W.partitionBy("column").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "column", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    inside = W.partitionBy("column", "_range").orderBy("value")
    codes = (
        ranged.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(offsets, ["column", "_range"])
        .select("column", "value", (F.col("_rank") + F.col("_offset")).cast("int").alias("code"))
    )
    return stage(codes, "value_codes")
