"""Wide or sparse sales into a dense daily panel with calendar and prices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit import settings
from panelkit.sources.schemas import WIDE_ID_COLUMNS


def day_columns(df: DataFrame, prefix: str = "d_", last: int | None = None) -> list[str]:
    """The day columns in day order; with `last`, only that many newest."""
    days = sorted(
        (c for c in df.columns if c.startswith(prefix) and c[len(prefix):].isdigit()),
        key=lambda c: int(c[len(prefix):]),
    )
    return days if last is None else days[-last:]


def melt_days(
    wide: DataFrame,
    ids: Sequence[str] = WIDE_ID_COLUMNS,
    prefix: str = "d_",
    last_days: int | None = None,
    order: str = settings.ORDER,
    value: str = settings.VALUE,
) -> DataFrame:
    """One row per series and day.

    `last_days` picks day columns before the melt, so cells that a later cut would drop are never
    produced. The day columns become one array that is exploded: a plan of N expressions, where
    `unpivot` would expand to N projections.
    """
    days = day_columns(wide, prefix, last_days)
    # One parsed expression: building thousands of literals one by one is slow on the driver.
    numbers = F.expr(f"array({', '.join(d[len(prefix):] for d in days)})")
    long = wide.select(*ids, F.posexplode(F.array(*days)).alias("_at", value))
    return long.select(*ids, F.get(numbers, F.col("_at")).alias(order), value)


def densify(
    cells: DataFrame,
    first_day: int | Column,
    last_day: int | Column,
    key: Sequence[str] = settings.SERIES_KEY,
    attributes: Sequence[str] = settings.SERIES_ATTRIBUTES,
    order: str = settings.ORDER,
    value: str = settings.VALUE,
    fill: int = 0,
) -> DataFrame:
    """A row for every series and day in the range, `fill` where nothing was recorded.

    Input: at most one row per series and day, over the whole history, so that a series without a
    row in the range is still kept. Each recorded row stands for the days from its own up to the
    one before the next, so only recorded cells are shuffled, never the dense grid, and the result
    stays hashed on the series key for the windows that follow. A task holds one row per day of a
    series at most.
    """
    first = F.lit(first_day) if isinstance(first_day, int) else first_day
    last = F.lit(last_day) if isinstance(last_day, int) else last_day
    in_order = W.partitionBy(*key).orderBy(order)
    following = F.lead(order).over(in_order)
    previous = F.lag(order).over(in_order)
    spans = cells.select(
        *key, *attributes, F.col(order).alias("_day"), value,
        # the first row of a series also stands for the days before it
        F.greatest(F.when(previous.isNull(), first).otherwise(F.col(order)), first).alias("_from"),
        F.least(F.coalesce(following - 1, last), last).alias("_to"),
    ).filter("_from <= _to")
    return spans.withColumn(
        order, F.explode(F.sequence("_from", "_to"))
    ).select(
        *key, *attributes, order,
        F.when(F.col(order) == F.col("_day"), F.col(value)).otherwise(F.lit(fill)).cast(
            cells.schema[value].dataType
        ).alias(value),
    )


def keep_items(df: DataFrame, items: DataFrame, item: str = "item_id") -> DataFrame:
    """Rows whose item is in the list."""
    return df.join(items.select(item), item, "left_semi")


def keep_last_days(df: DataFrame, days: int, order: str = settings.ORDER) -> DataFrame:
    """Rows of the newest `days` days, counted from the newest day in the table."""
    newest = df.agg(F.max(order)).scalar()
    return df.filter(F.col(order) >= F.greatest(F.lit(1), newest - (days - 1)))


def fill_events(
    calendar: DataFrame,
    columns: Sequence[str] = ("event_name_1", "event_type_1", "event_name_2", "event_type_2"),
) -> DataFrame:
    return calendar.fillna(settings.NO_EVENT, list(columns))


def join_calendar(df: DataFrame, calendar: DataFrame, order: str = settings.ORDER) -> DataFrame:
    """Attach the day's calendar row. The engine broadcasts it where its bytes are few."""
    return df.join(calendar, order, "left")


def join_prices(
    df: DataFrame,
    prices: DataFrame,
    keys: Sequence[str] = ("store_id", "item_id", "wm_yr_wk"),
) -> DataFrame:
    """Attach the week's price. Both sides may be large: the strategy is Catalyst's."""
    return df.join(prices, list(keys), "left")


def fill_prices(
    df: DataFrame,
    key: Sequence[str] = settings.SERIES_KEY,
    price: str = settings.PRICE,
    order: str = settings.ORDER,
) -> DataFrame:
    """Missing prices become the series median, or 0 where a series has no price at all.

    The window spans the series but is declared in day order, so that the feature windows on the
    same key and order reuse its exchange and its sort.
    """
    whole = W.partitionBy(*key).orderBy(order).rowsBetween(
        W.unboundedPreceding, W.unboundedFollowing
    )
    median = F.percentile(price, F.lit(0.5)).over(whole)
    return df.withColumn(price, F.coalesce(F.col(price), median, F.lit(0.0)))


def items_per_category(df: DataFrame, item: str = "item_id", category: str = "cat_id") -> DataFrame:
    return df.groupBy(category).agg(F.countDistinct(item).alias("n_items"))


def sample_items(
    df: DataFrame,
    target: int = settings.SAMPLE_ITEMS,
    minimum: int = settings.SAMPLE_MINIMUM,
    seed: int = settings.SEED,
    item: str = "item_id",
    category: str = "cat_id",
) -> DataFrame:
    """A sample of items, stratified by category in proportion to its distinct items.

    Every category gives floor(target * share), at least `minimum`, at most all it has. The draw
    orders items by a seeded hash, so it repeats exactly and needs no random state. A category
    never needs more than max(target, minimum) candidates; the constant rank bound lets Spark cut
    each partition to that many before any shuffle.
    """
    items = df.select(category, item).distinct()
    counts = items.groupBy(category).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    quota = counts.select(
        category,
        F.least(
            F.col("_n"),
            F.greatest(F.lit(minimum), F.floor(F.lit(target) * F.col("_n") / total)),
        ).alias("_quota"),
    )
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(item)))
    rank = F.row_number().over(W.partitionBy(category).orderBy("_draw", item))
    candidates = (
        items.withColumn("_draw", draw)
        .withColumn("_rank", rank)
        .filter(F.col("_rank") <= max(target, minimum))
    )
    return (
        candidates.join(quota, category)
        .filter(F.col("_rank") <= F.col("_quota"))
        .select(category, item)
    )


def sampled_per_category(sample: DataFrame, category: str = "cat_id") -> DataFrame:
    return sample.groupBy(category).agg(F.count("*").alias("n_sampled"))


def distinct_items(df: DataFrame, item: str = "item_id") -> DataFrame:
    return df.select(item).distinct()
