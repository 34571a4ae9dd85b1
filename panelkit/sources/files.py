"""Files in and out: wide sales, calendar, prices, panels, model metadata, document stores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit import settings
from panelkit.functions.columns import day_number
from panelkit.sources import schemas


def read_wide_sales(spark: SparkSession, path: str) -> DataFrame:
    """Wide sales CSV. Only the header line is looked at to name the day columns."""
    header = spark.read.csv(path, header=True).columns
    return spark.read.csv(path, header=True, schema=schemas.wide_sales_from_header(header))


def read_item_categories(spark: SparkSession, path: str) -> DataFrame:
    """The two columns that sampling needs; the CSV scan is pruned to them."""
    return read_wide_sales(spark, path).select("item_id", "cat_id")


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """Calendar CSV with a parsed date and a numeric `day_num` in place of `d`."""
    raw = spark.read.csv(path, header=True, schema=schemas.CALENDAR)
    return raw.select(
        day_number("d").alias("day_num"), *[c for c in raw.columns if c != "d"]
    )


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schemas.PRICES)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True)


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    """A panel or feature table; filters on the store prune whole directories."""
    return spark.read.parquet(path)


def write_panel(
    df: DataFrame,
    path: str,
    partition_by: str = "store_id",
    within: Sequence[str] = ("item_id", settings.ORDER),
    rows_per_file: int = 20_000_000,
) -> None:
    """One directory per store.

    Rows are brought together by store in partitions of even size: small stores share a writer, a
    large one is split over as many as its bytes call for.
    """
    (
        df.hint("rebalance", partition_by)
        .sortWithinPartitions(partition_by, *within)
        .write.option("maxRecordsPerFile", rows_per_file).partitionBy(partition_by)
        .parquet(path)
    )


def model_metadata(
    metrics: DataFrame, features: Sequence[str], training_info: dict[str, str] | None = None
) -> DataFrame:
    """One metadata row per model from a table of (model, rmse, mae, rmsse)."""
    names = [c for c in metrics.columns if c != "model"]
    info = training_info or {}
    info_map = (
        F.create_map(*[F.lit(x) for pair in info.items() for x in pair])
        if info
        else F.expr("cast(map() as map<string,string>)")
    )
    return metrics.select(
        F.col("model").alias("model_name"),
        F.array(*[F.lit(f) for f in features]).alias("features"),
        F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast("double"))]).alias("metrics"),
        info_map.alias("training_info"),
        F.lit("regressor").alias("type"),
    )


def write_model_metadata(metadata: DataFrame, path: str) -> None:
    metadata.write.json(path)


def read_model_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MODEL_METADATA).json(path)


def list_models(metadata: DataFrame, names: Sequence[str]) -> DataFrame:
    """Every expected model with its status, metrics and number of features."""
    spark = metadata.sparkSession
    expected = spark.createDataFrame([(n,) for n in names], "model_name string")
    return expected.join(metadata, "model_name", "left").select(
        "model_name",
        F.when(F.col("type").isNotNull(), "loaded").otherwise("not_available").alias("status"),
        "metrics",
        F.when(F.col("features").isNotNull(), F.size("features")).alias("n_features"),
    )
