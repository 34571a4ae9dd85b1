"""From sales, calendar and prices to the feature table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit import settings
from panelkit.functions.ranking import value_codes
from panelkit.operators import features as X
from panelkit.operators import panel as P
from panelkit.operators.split import mark_split
from panelkit.sources import trade
from panelkit.storage import stage


def build_panel(
    wide: DataFrame,
    calendar: DataFrame,
    prices: DataFrame,
    sample_size: int | None = None,
    history_days: int | None = None,
) -> DataFrame:
    """Wide sales, calendar and prices to the dense panel.

    `sample_size` draws a stratified sample of items first; by default every item is kept. The
    history cut picks day columns before the melt.
    """
    if sample_size is not None:
        items = P.sample_items(wide, target=sample_size)
        wide, prices = P.keep_items(wide, items), P.keep_items(prices, items)
    long = P.melt_days(wide, last_days=history_days)
    dated = P.join_calendar(long, P.fill_events(calendar))
    return P.fill_prices(P.join_prices(dated, prices))


def assemble(
    panel: DataFrame, series: DataFrame, snap: Column, spec: X.Series = X.Series()
) -> DataFrame:
    """Series columns, then series attributes by key, then row expressions.

    `panel` carries calendar features already; `series` has one row per series with its averages
    and codes. Windows and the last join share one exchange on the series key.
    """
    along = X.add_series_columns(panel, *X.sales_builders(), series=spec)
    attributes = [c for c in series.columns if c in spec.key or c not in panel.columns]
    joined = along.join(series.select(*attributes), list(spec.key))
    return X.add_interactions(X.add_relative_sales(joined), snap)


def describe_series(series: DataFrame) -> DataFrame:
    """Series table with group averages and codes of its identifiers.

    Written before and after: the totals are worked out once, and the size of the result decides
    whether it is broadcast to the rows or joined where they already are.
    """
    series = stage(series, "series_totals")
    of_series = [c for c in settings.ENCODED if c in series.columns]
    means = X.group_means(series, X.AVERAGES)
    coded = X.encode(means, of_series, value_codes(series, of_series))
    return stage(coded.drop("_sum", "_n"), "series")


def build_features(
    panel: DataFrame, snap: Column, spec: X.Series = X.Series()
) -> DataFrame:
    """The feature table of any dense panel that carries its calendar columns."""
    dated = X.add_calendar_features(panel)
    coded = X.encode_few(dated, "weekday")
    table = assemble(coded, describe_series(X.series_table(panel)), snap, spec)
    return mark_split(X.drop_raw_columns(table))


def trade_features(
    spark: SparkSession,
    folder: str,
    history_days: int | None = None,
    spec: X.Series = X.Series(),
    snap_columns: Mapping[str, str] = trade.SNAP_COLUMNS,
) -> DataFrame:
    """The feature table of the order-line tables.

    Everything that depends on the day alone is computed on the calendar, everything that depends
    on the series alone on the sold cells (days without sales add nothing to a sum); only the
    windows see the dense rows.
    """
    cells = trade.daily_cells(spark, folder)
    first, last = trade.day_range(cells, history_days)
    days = X.add_calendar_features(P.fill_events(trade.calendar(spark, first, last)))
    panel = trade.dated_panel(cells, X.encode_few(days, "weekday"), first, last)
    recent = F.when(F.col(settings.ORDER) >= first, F.col(settings.VALUE))
    series = cells.groupBy(*settings.SERIES_KEY, *settings.SERIES_ATTRIBUTES).agg(
        F.coalesce(F.sum(recent), F.lit(0)).alias("_sum"),
        F.lit(last - first + 1).cast("long").alias("_n"),
    )
    table = assemble(
        panel, describe_series(series),
        trade.choose_by(F.col("state_id"), snap_columns), spec,
    )
    validation_start = last - settings.VALIDATION_DAYS + 1
    return X.drop_raw_columns(table).withColumn(
        "split", F.when(F.col(settings.ORDER) >= validation_start, "val").otherwise("train")
    )
