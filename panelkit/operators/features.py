"""Features of a dense daily panel.

Columns that look along a series are all computed in one pass: one exchange on the series key, one
sort, one window node. Columns that depend only on the day belong on the calendar, and columns that
depend only on the series on a one-row-per-series table; both are joined on afterwards.

A series holds one row per day, so one task per series is a bounded amount of work for daily data.
For panels with a very long time axis set `Series.block_days`: a series is then cut into blocks
that different tasks work on, each with the tail of the block before it, and whatever runs from
the start of the series is carried over from one-row-per-block totals. The panel must be dense for
that (`densify`).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit import settings
from panelkit.functions import columns as C
from panelkit.functions.ranking import value_codes
from panelkit.storage import stage


@dataclass(frozen=True)
class Series:
    """What makes a series, and what orders it."""

    key: tuple[str, ...] = settings.SERIES_KEY
    order: str = settings.ORDER
    value: str = settings.VALUE
    price: str = settings.PRICE
    block_days: int | None = None


@dataclass(frozen=True)
class View:
    """The windows over a series (or one of its blocks) and what came before it."""

    series: Series
    rows: WindowSpec
    own: Column  # whether a row is the block's own, not borrowed from the block before
    total: Column  # sum of the values before the block
    count: Column  # rows before the block
    quiet: Column  # zero rows in a row just before the block
    last_sale: Column  # last day with a positive value before the block

    def previous(self, n: int) -> WindowSpec:
        return self.rows.rowsBetween(-n, -1)

    @property
    def earlier(self) -> WindowSpec:
        return self.rows.rowsBetween(W.unboundedPreceding, -1)


Builder = Callable[[View], Mapping[str, Column]]


# --------------------------------------------------------------------------- series columns


def lags(periods: Sequence[int] = settings.LAGS) -> Builder:
    """The value some days ago."""
    def build(v: View) -> dict[str, Column]:
        s = v.series
        return {f"{s.value}_lag_{n}": F.lag(s.value, n).over(v.rows) for n in periods}
    return build


def _rolling(statistic: Callable[[Column], Column], suffix: str) -> Callable[..., Builder]:
    def with_windows(windows: Sequence[int] = settings.WINDOWS) -> Builder:
        def build(v: View) -> dict[str, Column]:
            s = v.series
            return {
                f"{s.value}_r{n}_{suffix}": statistic(F.col(s.value), v.previous(n))
                for n in windows
            }
        return build
    return with_windows


# Windows end yesterday. Fewer rows than the window are used as they are; no row gives null,
# except that a deviation of fewer than two rows counts as 0.
rolling_mean = _rolling(lambda x, w: F.avg(x).over(w), "mean")
rolling_std = _rolling(lambda x, w: F.coalesce(F.stddev_samp(x).over(w), F.lit(0.0)), "std")
rolling_min = _rolling(lambda x, w: F.min(x).over(w), "min")
rolling_max = _rolling(lambda x, w: F.max(x).over(w), "max")
# `median` takes no frame; `percentile` does, and interpolates exactly.
rolling_median = _rolling(lambda x, w: F.percentile(x, F.lit(0.5)).over(w), "median")


def expanding_mean() -> Builder:
    """The mean of everything up to yesterday."""
    def build(v: View) -> dict[str, Column]:
        s = v.series
        own = F.when(v.own, F.col(s.value))
        total = v.total + F.coalesce(F.sum(own).over(v.earlier), F.lit(0))
        count = v.count + F.count(own).over(v.earlier)
        return {f"{s.value}_expanding_mean": F.try_divide(total.cast("double"), count)}
    return build


def price_changes() -> Builder:
    """Difference and relative difference to yesterday's price."""
    def build(v: View) -> dict[str, Column]:
        price = F.col(v.series.price)
        before = F.lag(price, 1).over(v.rows)
        return {
            "price_change": price - before,
            "price_change_pct": C.safe_ratio(price - before, before, 0),
        }
    return build


def price_mean(windows: Sequence[int] = settings.PRICE_WINDOWS) -> Builder:
    def build(v: View) -> dict[str, Column]:
        return {f"price_r{n}_mean": F.avg(v.series.price).over(v.previous(n)) for n in windows}
    return build


def price_std(windows: Sequence[int] = settings.PRICE_WINDOWS) -> Builder:
    def build(v: View) -> dict[str, Column]:
        return {
            f"price_r{n}_std": F.coalesce(
                F.stddev_samp(v.series.price).over(v.previous(n)), F.lit(0.0)
            )
            for n in windows
        }
    return build


def discount(window: int = 28) -> Builder:
    """Price relative to its recent maximum."""
    def build(v: View) -> dict[str, Column]:
        price = F.col(v.series.price)
        top = F.max(price).over(v.previous(window))
        return {"discount": C.safe_ratio(price - top, top, 0)}
    return build


def price_momentum(days: int = 7) -> Builder:
    """Price relative to what it was some days ago."""
    def build(v: View) -> dict[str, Column]:
        price = F.col(v.series.price)
        before = F.lag(price, days).over(v.rows)
        return {"price_momentum": C.safe_ratio(price - before, before, 0)}
    return build


def zero_streak() -> Builder:
    """Days in a row without sales, ending yesterday."""
    def build(v: View) -> dict[str, Column]:
        value = F.col(v.series.value)
        # Position of a row among the block's own rows, and of the last one with sales.
        position = F.count(F.when(v.own, 1)).over(v.rows.rowsBetween(W.unboundedPreceding, -1))
        running = F.count(F.when(v.own, 1)).over(v.rows.rowsBetween(W.unboundedPreceding, 0))
        return {
            "_position": position,
            "_sold_at": F.when(v.own & (value != 0), running),
        }
    return build


def days_since_sale(never: int = settings.NEVER_SOLD_DAYS) -> Builder:
    """On a day with sales, the days since the sale before it; `never` on all other days."""
    def build(v: View) -> dict[str, Column]:
        s = v.series
        sold = F.col(s.value) > 0
        last = F.last(F.when(v.own & sold, F.col(s.order)), ignorenulls=True).over(v.earlier)
        since = F.when(sold, F.col(s.order) - F.coalesce(last, v.last_sale))
        return {"days_since_sale": F.coalesce(since, F.lit(never)).cast("int")}
    return build


def _blocks(df: DataFrame, s: Series, halo: int) -> tuple[DataFrame, View]:
    """Rows copied to the block that needs them, next to what that block must be told."""
    size = s.block_days
    if size < halo:
        raise ValueError(f"block_days must be at least {halo}, the longest look-back")
    block = F.floor(F.col(s.order) / size).cast("int")
    keys = [*s.key, "_block"]
    totals = df.withColumn("_block", block).groupBy(*keys).agg(
        F.sum(s.value).alias("_sum"),
        F.count(s.value).alias("_n"),
        F.count("*").alias("_rows"),
        F.max(s.order).alias("_end"),
        F.max(F.when(F.col(s.value) != 0, F.col(s.order))).alias("_busy"),
        F.max(F.when(F.col(s.value) > 0, F.col(s.order))).alias("_sold"),
    )
    before = W.partitionBy(*s.key).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    rows_before = F.coalesce(F.sum("_rows").over(before), F.lit(0))
    last_day = F.max("_end").over(before)
    busy = F.max("_busy").over(before)
    carried = totals.select(
        *keys,
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_c_total"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_c_count"),
        F.coalesce(last_day - busy, rows_before).cast("long").alias("_c_quiet"),
        F.max("_sold").over(before).alias("_c_last_sale"),
    )
    in_tail = F.pmod(F.col(s.order), F.lit(size)) >= size - halo
    homes = F.when(in_tail, F.array(block, block + 1)).otherwise(F.array(block))
    copied = df.withColumn("_own_block", block).withColumn("_block", F.explode(homes))
    joined = copied.join(carried, keys).withColumn("_own", F.col("_block") == F.col("_own_block"))
    view = View(
        s, W.partitionBy(*keys).orderBy(s.order), F.col("_own"),
        F.col("_c_total"), F.col("_c_count"), F.col("_c_quiet"), F.col("_c_last_sale"),
    )
    return joined, view


def add_series_columns(
    df: DataFrame, *builders: Builder, series: Series = Series(), halo: int = max(settings.LAGS)
) -> DataFrame:
    """Add the builders' columns, all in the same pass over the series.

    `halo` is the longest look-back of the builders, in rows; it matters with `block_days` only.
    """
    if series.block_days is None:
        rows = df
        view = View(
            series, W.partitionBy(*series.key).orderBy(series.order), F.lit(True),
            F.lit(0), F.lit(0), F.lit(0), F.lit(None).cast("int"),
        )
    else:
        rows, view = _blocks(df, series, halo)
    made: dict[str, Column] = {}
    for build in builders:
        made.update(build(view))
    out = rows.withColumns(made)
    kept = [c for c in df.columns if c not in made]
    names = [c for c in made if not c.startswith("_")]
    if "_sold_at" in made:
        # Needs a window over a window column: same key and order, so no further exchange or sort.
        busy = F.max("_sold_at").over(view.earlier)
        out = out.withColumn(
            "zero_streak",
            F.coalesce(F.col("_position") - busy, F.col("_position") + view.quiet).cast("int"),
        )
        names.append("zero_streak")
    if series.block_days is not None:
        out = out.filter("_own")
    return out.select(*kept, *names)


def sales_builders() -> list[Builder]:
    """Every builder behind the model features."""
    return [
        lags(), rolling_mean(), rolling_std(), rolling_min(), rolling_max(), rolling_median(),
        expanding_mean(), price_changes(), price_mean(), price_std(), discount(),
        price_momentum(), zero_streak(), days_since_sale(),
    ]


# --------------------------------------------------------------------------- calendar columns


def add_calendar_features(
    df: DataFrame,
    date: str = "date",
    month: str = "month",
    wday: str = "wday",
    event_types: Sequence[str] = settings.EVENT_TYPES,
) -> DataFrame:
    """Date parts, weekend and month-edge flags, cyclic encodings and event flags.

    They depend on the day alone: apply them to the calendar, one row per day, before it is joined.
    """
    month_sin, month_cos = C.cycle(F.col(month), 12)
    wday_sin, wday_cos = C.cycle(F.col(wday), 7)
    first, second = C.has_event("event_type_1"), C.has_event("event_type_2")
    return df.withColumns({
        "day_of_month": F.dayofmonth(date),
        "day_of_year": F.dayofyear(date),
        "week_of_year": F.weekofyear(date),
        "quarter": F.quarter(date),
        "is_weekend": C.flag(F.col(wday) <= 2),
        "is_month_start": C.flag(F.dayofmonth(date) == 1),
        "is_month_end": C.flag(F.col(date) == F.last_day(date)),
        "month_sin": month_sin, "month_cos": month_cos,
        "wday_sin": wday_sin, "wday_cos": wday_cos,
        "has_event1": first,
        "has_event2": second,
        "has_any_event": F.greatest(first, second),
        **{f"event_{e.lower()}": C.event_flag(e) for e in event_types},
    })


# --------------------------------------------------------------------------- per-series columns


def series_table(
    df: DataFrame,
    key: Sequence[str] = settings.SERIES_KEY,
    attributes: Sequence[str] = settings.SERIES_ATTRIBUTES,
    value: str = settings.VALUE,
) -> DataFrame:
    """One row per series: its attributes, and sum and count of its values.

    Partial sums are taken before the exchange, so a series with very many rows costs one row per
    task.
    """
    return df.groupBy(*key, *attributes).agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_n")
    )


def add_group_means(
    df: DataFrame, groups: Mapping[str, str], series: DataFrame, key: Sequence[str] = settings.SERIES_KEY
) -> DataFrame:
    """Mean of the value over all rows of a group, on every row of the group.

    `groups` maps a series attribute to the name of its mean. The means come from the series table
    and travel to the rows by the series key: the rows are never shuffled by the few, uneven
    groups themselves. The series table is written first: every mean is joined to it.
    """
    series = stage(series, "series_totals")
    return df.join(group_means(series, groups).select(*key, *groups.values()), list(key))


def group_means(series: DataFrame, groups: Mapping[str, str]) -> DataFrame:
    """The series table with a mean per group. It is read twice per group: pass a written table."""
    for by, name in groups.items():
        means = series.groupBy(by).agg(
            (F.sum("_sum").cast("double") / F.sum("_n")).alias(name)
        )
        series = series.join(means, by)
    return series


def encode(df: DataFrame, columns: Sequence[str], codes: DataFrame, missing: int = -1) -> DataFrame:
    """Add `<column>_enc`, the position of the value among the sorted values; -1 for null.

    `codes` comes from `value_codes`, a written table: its measured size decides on broadcasting.
    """
    for column in columns:
        mapping = codes.filter(F.col("column") == column).select(
            F.col("value").alias(column), F.col("code").alias(f"{column}_enc")
        )
        df = df.join(mapping, column, "left").fillna(missing, [f"{column}_enc"])
    return df


def encode_few(df: DataFrame, column: str, missing: int = -1) -> DataFrame:
    """`encode` for a column that has a handful of values by its nature, such as weekdays.

    The sorted values are one small array, found once and looked up in every row: no join.
    """
    values = df.agg(F.array_sort(F.collect_set(column))).scalar()
    place = F.array_position(values, F.col(column)).cast("int") - 1
    return df.withColumn(f"{column}_enc", F.coalesce(place, F.lit(missing)))


AVERAGES = {
    "store_id": "store_avg_sales", "cat_id": "cat_avg_sales", "item_id": "item_avg_sales",
}


def add_encodings(
    df: DataFrame,
    columns: Sequence[str] = settings.ENCODED,
    key: Sequence[str] = settings.SERIES_KEY,
    few: Sequence[str] = ("weekday",),
) -> DataFrame:
    """Label-encode series attributes and other low-cardinality columns of a panel.

    The codes are worked out on distinct combinations, not on the rows; `few` names the columns
    with a handful of values.
    """
    of_series = [c for c in columns if c in {*key, *settings.SERIES_ATTRIBUTES}]
    others = [c for c in columns if c not in of_series and c not in few]
    series = df.select(*dict.fromkeys([*key, *of_series])).distinct()
    series = stage(series, "series")
    encoded = encode(series, of_series, value_codes(series, of_series))
    out = df.join(encoded.select(*key, *[f"{c}_enc" for c in of_series]), list(key))
    for column in (c for c in columns if c in few):
        out = encode_few(out, column)
    return encode(out, others, value_codes(df.select(*others).distinct(), others)) if others else out


# --------------------------------------------------------------------------- row columns


def add_relative_sales(df: DataFrame, value: str = settings.VALUE) -> DataFrame:
    """Difference to the store's and the category's average. Leaky: it contains today's value."""
    return df.withColumns({
        "sales_vs_store_avg": F.col(value) - F.col("store_avg_sales"),
        "sales_vs_cat_avg": F.col(value) - F.col("cat_avg_sales"),
    })


def add_interactions(
    df: DataFrame, snap: Column, price: str = settings.PRICE
) -> DataFrame:
    """Products of price, events, weekends and benefit days, and the short-to-long trend."""
    trend = C.safe_ratio(F.col("sales_r7_mean"), F.col("sales_r28_mean"), 1)
    return df.withColumn("snap", snap).withColumns({
        "price_x_event": F.col(price) * F.col("has_any_event"),
        "weekend_x_lag7": F.col("is_weekend") * F.col("sales_lag_7"),
        "snap_x_price": F.col("snap") * F.col(price),
        "trend_7_28": trend,
    })


def drop_raw_columns(df: DataFrame, columns: Sequence[str] = settings.DROPPED_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def feature_names(df: DataFrame, exclude: Sequence[str] = settings.NON_FEATURES) -> list[str]:
    """Every column that is neither the target nor an identifier."""
    return [c for c in df.columns if c not in exclude]
