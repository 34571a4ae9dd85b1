"""A retail panel out of order-line tables (lineitem, part, supplier, nation, region).

Suppliers' regions become states with two stores each, part brands become items, and the shipped
quantity per day becomes sales.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit import settings
from panelkit.functions.columns import choose_by, saturday_first
from panelkit.operators import panel as P
from panelkit.sources import schemas
from panelkit.storage import stage

# The Monday that week and day numbers count from.
ORIGIN = dt.date(1995, 1, 2)
# State of the panel -> column with its benefit-payment days.
SNAP_COLUMNS = {"AFRICA": "snap_CA", "AMERICA": "snap_TX", "ASIA": "snap_WI"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shipping_days(spark: SparkSession, folder: str) -> tuple[int, int]:
    """First and last day number in the order lines."""
    low, high = (
        table(spark, folder, "lineitem")
        .agg(F.min("l_shipdate").cast("date"), F.max("l_shipdate").cast("date"))
        .first()
    )
    return (low - ORIGIN).days + 1, (high - ORIGIN).days + 1


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with the raw parts of the panel keys; cents and units are exact integers.

    The joins are left-deep from the lines, so that each dimension is judged by its own file size.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_suppkey", "l_partkey",
        F.col("l_quantity").cast("long").alias("units"),
        (F.col("l_extendedprice") * 100 + 0.5).cast("long").alias("cents"),
        (F.datediff(F.col("l_shipdate").cast("date"), F.lit(ORIGIN)) + 1).alias(settings.ORDER),
    )
    return (
        lines
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "r_name", (F.col("s_suppkey") % 2 + 1).cast("int").alias("door"), "p_brand",
            settings.ORDER, "units", "cents",
        )
    )


RAW_KEY = ("r_name", "door", "p_brand")


def panel_keys() -> dict[str, Column]:
    """Names of store, item, department, category and state, from the raw parts."""
    number = F.substring_index("p_brand", "#", -1).cast("int")
    state = F.replace("r_name", F.lit(" "), F.lit("_"))
    return {
        "store_id": F.concat_ws("_", state, "door"),
        "item_id": F.col("p_brand"),
        "dept_id": F.concat(F.lit("CAT_"), number % 3, F.lit("_"), number % 2 + 1),
        "cat_id": F.concat(F.lit("CAT_"), number % 3),
        "state_id": state,
    }


def sales_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Units sold per store, item and day; days without sales are absent."""
    cells = order_lines(spark, folder).groupBy(*RAW_KEY, settings.ORDER).agg(
        F.sum("units").alias("sales")
    )
    return cells.select(
        *[c.alias(n) for n, c in panel_keys().items()], settings.ORDER, "sales"
    )


def week_of(day: Column) -> Column:
    return F.floor((day - 1) / 7).cast("int")


def nearest_cent() -> Column:
    """c cents over u units, to the cent, in whole numbers up to the last step."""
    return F.expr("(2 * c + u) div (2 * u)") / F.lit(100.0)


def week_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Average unit price per store, item and week, to the cent; weeks without sales are absent."""
    per_week = (
        order_lines(spark, folder)
        .groupBy(*RAW_KEY, week_of(F.col(settings.ORDER)).alias("wm_yr_wk"))
        .agg(F.sum("cents").alias("c"), F.sum("units").alias("u"))
    )
    keys = panel_keys()
    return per_week.select(
        keys["store_id"].alias("store_id"), keys["item_id"].alias("item_id"), "wm_yr_wk",
        nearest_cent().alias("sell_price"),
    )


def calendar(spark: SparkSession, first_day: int, last_day: int) -> DataFrame:
    """A calendar row for every day number in the range."""
    date = F.date_add(F.lit(ORIGIN), F.col("day_num") - 1)
    days = spark.range(first_day, last_day + 1, numPartitions=1).select(
        F.col("id").cast("int").alias("day_num")
    ).withColumn("date", date)
    month_day = F.date_format("date", "MM-dd")
    super_sunday = (
        (F.month("date") == 2) & (F.dayofmonth("date") <= 7) & (F.dayofweek("date") == 1)
    )
    # The invented holidays of the panel.
    holidays = [
        (month_day == "12-25", "Christmas", "Religious"),
        (month_day == "07-04", "IndependenceDay", "National"),
        (month_day == "10-31", "Halloween", "Cultural"),
        (super_sunday, "SuperBowl", "Sporting"),
        (month_day == "09-01", "LaborDay", "Federal"),
    ]
    name_1 = F.coalesce(*[F.when(c, F.lit(n)) for c, n, _ in holidays])
    type_1 = F.coalesce(*[F.when(c, F.lit(t)) for c, _, t in holidays])
    day = F.dayofmonth("date")
    return days.select(
        "day_num",
        "date",
        week_of(F.col("day_num")).alias("wm_yr_wk"),
        F.date_format("date", "EEEE").alias("weekday"),
        saturday_first(F.col("date")).alias("wday"),
        F.month("date").alias("month"),
        F.year("date").alias("year"),
        name_1.alias("event_name_1"),
        type_1.alias("event_type_1"),
        F.when(month_day == "12-25", "WinterFair").alias("event_name_2"),
        F.when(month_day == "12-25", "Cultural").alias("event_type_2"),
        (day <= 10).cast("int").alias("snap_CA"),
        ((day <= 15) & (day % 2 == 1)).cast("int").alias("snap_TX"),
        ((day <= 15) & (day % 2 == 0)).cast("int").alias("snap_WI"),
    )


def snap_by_state(state: Column) -> Column:
    return choose_by(state, SNAP_COLUMNS)


def daily_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Units and cents per store, item and day, written once.

    It is what the order lines come down to for everything that follows: range of days, sales,
    prices and series totals are all taken from it instead of from the lines again.
    """
    cells = order_lines(spark, folder).groupBy(*RAW_KEY, settings.ORDER).agg(
        F.sum("units").alias("sales"), F.sum("cents").alias("cents")
    )
    return stage(
        cells.select(
            *[c.alias(n) for n, c in panel_keys().items()], settings.ORDER, "sales", "cents"
        ),
        "daily_cells",
    )


def day_range(cells: DataFrame, history_days: int | None = None) -> tuple[int, int]:
    """First and last day of the cells, or of their newest days."""
    first, last = cells.agg(F.min(settings.ORDER), F.max(settings.ORDER)).first()
    return (first if history_days is None else max(first, last - history_days + 1)), last


def cell_prices(cells: DataFrame) -> DataFrame:
    """`week_prices` from daily cells."""
    return (
        cells.groupBy("store_id", "item_id", week_of(F.col(settings.ORDER)).alias("wm_yr_wk"))
        .agg(F.sum("cents").alias("c"), F.sum("sales").alias("u"))
        .select("store_id", "item_id", "wm_yr_wk", nearest_cent().alias("sell_price"))
    )


def dense_sales(spark: SparkSession, folder: str, history_days: int | None = None) -> DataFrame:
    """Sales for every series and day; with `history_days`, only the newest days."""
    first, last = shipping_days(spark, folder)
    if history_days is not None:
        first = max(first, last - history_days + 1)
    return P.densify(sales_cells(spark, folder), first, last)


def dated_panel(cells: DataFrame, days: DataFrame, first_day: int, last_day: int) -> DataFrame:
    """Dense sales with the given calendar, and prices with their gaps filled.

    One exchange of the sold cells on the series key serves the densifying, the price join and
    the fill; the dense rows themselves never move.
    """
    dense = P.densify(cells.drop("cents"), first_day, last_day)
    dated = dense.join(days, settings.ORDER, "left")
    return P.fill_prices(P.join_prices(dated, cell_prices(cells)))


def panel(spark: SparkSession, folder: str, history_days: int | None = None) -> DataFrame:
    """The dense panel with calendar and prices: the input of every feature operator."""
    cells = daily_cells(spark, folder)
    first, last = day_range(cells, history_days)
    days = P.fill_events(calendar(spark, first, last))
    return dated_panel(cells, days, first, last).select(
        F.concat_ws("_", "item_id", "store_id").alias("id"),
        "store_id", "item_id", "dept_id", "cat_id", "state_id", "day_num", "sales",
        *[c for c in days.columns if c != "day_num"], "sell_price",
    )


def panel_columns() -> list[str]:
    """The panel's columns, without the row label."""
    return [f.name for f in schemas.PANEL.fields if f.name != "id"]
