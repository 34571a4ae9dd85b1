"""Queries: feature columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit import settings
from panelkit.catalog import sql
from panelkit.functions.columns import event_flag
from panelkit.operators import features as X
from panelkit.operators import panel as P
from panelkit.operators import split as S
from panelkit.plans.features import trade_features
from panelkit.sources import trade

KEY = ("store_id", "item_id", "day_num")
DIGITS = 6


# Means over a long history need more digits than a decimal tie can have; deviations of large
# prices fewer, for the last bits depend on the order of summation.
EXPANDING_DIGITS = 8
PRICE_STD_DIGITS = 3


def _out(df: DataFrame, columns, key=KEY, digits: int = DIGITS) -> DataFrame:
    """Key and columns: numbers that may be null as doubles, rounded half to even."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def shown(name):
        if kinds[name] == "double":
            places = _places(name) if digits == DIGITS else digits
            return F.bround(name, places).alias(name)
        if kinds[name] == "bigint":
            return F.col(name).cast("double").alias(name)
        return F.col(name)

    return df.select(*key, *[shown(c) for c in columns])


def _along(builder, columns, priced: bool = False, series: X.Series = X.Series()):
    """A query that adds a builder's columns to the whole panel."""
    def run(spark, folder):
        rows = trade.panel(spark, folder) if priced else trade.dense_sales(spark, folder)
        return _out(X.add_series_columns(rows, builder, series=series), columns)
    return run


def sales_lags(spark, folder):
    return _along(X.lags(), settings.LAG_FEATURES)(spark, folder)


def _rolling(builder, suffix):
    return _along(builder, [f"sales_r{n}_{suffix}" for n in settings.WINDOWS])


def expanding_mean(spark, folder):
    return _along(X.expanding_mean(), ["sales_expanding_mean"])(spark, folder)


def calendar_features(spark, folder):
    """Date parts, flags, cycles and event flags on every calendar day."""
    days = P.fill_events(trade.calendar(spark, *trade.shipping_days(spark, folder)))
    return _out(X.add_calendar_features(days), settings.CALENDAR_FEATURES, key=("day_num",))


def weekend_flag(spark, folder):
    days = P.fill_events(trade.calendar(spark, *trade.shipping_days(spark, folder)))
    return X.add_calendar_features(days).select("date", "wday", "is_weekend")


def event_flags(spark, folder):
    """Event flags on every row of the panel."""
    rows = trade.panel(spark, folder)
    return rows.select(
        *KEY, *[event_flag(e).alias(f"event_{e.lower()}") for e in settings.EVENT_TYPES]
    )


def label_codes(spark, folder):
    """Codes of the six encoded columns on every row."""
    first, last = trade.shipping_days(spark, folder)
    rows = trade.dense_sales(spark, folder).join(
        trade.calendar(spark, first, last), "day_num"
    )
    return X.add_encodings(rows).select(*KEY, *[f"{c}_enc" for c in settings.ENCODED])


def group_averages(spark, folder):
    rows = trade.dense_sales(spark, folder)
    out = X.add_group_means(rows, X.AVERAGES, X.series_table(rows))
    return _out(out, X.AVERAGES.values())


def relative_sales(spark, folder):
    rows = trade.dense_sales(spark, folder)
    out = X.add_relative_sales(X.add_group_means(rows, X.AVERAGES, X.series_table(rows)))
    return _out(out, ["sales_vs_store_avg", "sales_vs_cat_avg"])


def interactions(spark, folder):
    """Price, event, weekend and benefit-day products, and the short-to-long trend."""
    rows = X.add_calendar_features(trade.panel(spark, folder))
    along = X.add_series_columns(rows, X.lags((7,)), X.rolling_mean((7, 28)))
    out = X.add_interactions(along, trade.snap_by_state(F.col("state_id")))
    return _out(out, settings.INTERACTION_FEATURES)


# Sums of these differ between engines in the last bits, so their largest value is compared.
FRACTIONAL = tuple(
    c for c in settings.FEATURE_COLUMNS
    if c.endswith(("_mean", "_std", "_sin", "_cos", "_avg_sales", "_avg", "_pct", "_7_28"))
    or c in ("discount", "price_momentum", "sales_expanding_mean")
)


def _places(name: str) -> int:
    if name.endswith("expanding_mean"):
        return EXPANDING_DIGITS
    return PRICE_STD_DIGITS if name.startswith("price_r") and name.endswith("_std") else DIGITS


def feature_table(spark, folder):
    """The 80 model features of every series on all days, summed up per series and split."""
    table = trade_features(spark, folder)
    checks = []
    for c in settings.FEATURE_COLUMNS:
        x = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        checks.append(
            (F.bround(F.max(x), _places(c)) if c in FRACTIONAL else F.bround(F.sum(x), 4)).alias(c)
        )
    totals = table.groupBy("store_id", "item_id", "split").agg(F.count("*").alias("n_rows"), *checks)
    return totals.withColumns({c: F.col(c) + 0.0 for c in settings.FEATURE_COLUMNS})


def feature_list(spark, folder):
    """The model features, by exclusion of all other columns, and how many rows have each."""
    table = trade_features(spark, folder).drop("split")
    names = X.feature_names(table)
    return table.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "feature", "n_values")


def warm_up_dropped(spark, folder):
    """Rows kept per series and split once incomplete training rows are gone."""
    rows = S.mark_split(trade.panel(spark, folder))
    along = X.add_series_columns(
        rows, X.lags(), X.rolling_mean((7,)), X.rolling_std((7,)), X.price_mean((7,))
    )
    kept = S.fill_missing(S.drop_warm_up(along), S.warm_up_columns(along))
    return kept.groupBy("store_id", "item_id", "split").agg(
        F.count("*").alias("n_rows"), F.min("day_num").alias("first_day"),
        F.sum("sales_lag_56").alias("sum_lag_56"),
    )


def event_type_lags(spark, folder):
    """Lags, rolling means and streaks of a second, differently keyed panel: events per day."""
    events = trade.table(spark, folder, "events")
    cells = events.select(
        "event_type",
        (F.col("user_id") % 10).alias("user_group"),
        (F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) + 1).alias("day"),
    ).groupBy("event_type", "user_group", "day").agg(F.count("*").alias("hits"))
    last = cells.agg(F.max("day")).scalar()
    key = ("event_type", "user_group")
    dense = P.densify(cells, 1, last, key=key, attributes=(), order="day", value="hits")
    series = X.Series(key=key, order="day", value="hits")
    out = X.add_series_columns(
        dense, X.lags((1, 7)), X.rolling_mean((7,)), X.expanding_mean(), X.zero_streak(),
        series=series,
    )
    return _out(
        out, ["hits", "hits_lag_1", "hits_lag_7", "hits_r7_mean", "hits_expanding_mean", "zero_streak"],
        key=(*key, "day"),
    )


def series_in_blocks(spark, folder):
    """The look-back columns computed on blocks of 365 days of a series, side by side."""
    rows = trade.dense_sales(spark, folder)
    out = X.add_series_columns(
        rows, X.lags((1, 56)), X.rolling_mean((28,)), X.expanding_mean(), X.zero_streak(),
        X.days_since_sale(), series=X.Series(block_days=365),
    )
    return _out(out, [
        "sales_lag_1", "sales_lag_56", "sales_r28_mean", "sales_expanding_mean", "zero_streak",
        "days_since_sale",
    ])


QUERIES = {
    "calendar_features": calendar_features,
    "weekend_flag": weekend_flag,
    "event_flags": event_flags,
    "sales_lags": sales_lags,
    "rolling_mean": _rolling(X.rolling_mean(), "mean"),
    "rolling_std": _rolling(X.rolling_std(), "std"),
    "rolling_min": _rolling(X.rolling_min(), "min"),
    "rolling_max": _rolling(X.rolling_max(), "max"),
    "rolling_median": _rolling(X.rolling_median(), "median"),
    "expanding_mean": expanding_mean,
    "price_changes": _along(X.price_changes(), ["price_change", "price_change_pct"], True),
    "price_rolling_mean": _along(X.price_mean(), ["price_r7_mean", "price_r28_mean"], True),
    "price_rolling_std": _along(X.price_std(), ["price_r7_std", "price_r28_std"], True),
    "price_discount": _along(X.discount(), ["discount"], True),
    "price_momentum": _along(X.price_momentum(), ["price_momentum"], True),
    "label_codes": label_codes,
    "group_averages": group_averages,
    "relative_sales": relative_sales,
    "zero_streak": _along(X.zero_streak(), ["zero_streak"]),
    "days_since_sale": _along(X.days_since_sale(), ["days_since_sale"]),
    "interactions": interactions,
    "feature_table": feature_table,
    "feature_list": feature_list,
    "warm_up_dropped": warm_up_dropped,
    "event_type_lags": event_type_lags,
    "series_in_blocks": series_in_blocks,
}

# ------------------------------------------------------------------------------------ SQL

_W = "(PARTITION BY store_id, item_id ORDER BY day_num)"


def _prev(n: int) -> str:
    return f"(PARTITION BY store_id, item_id ORDER BY day_num ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


_ALL_PREV = (
    "(PARTITION BY store_id, item_id ORDER BY day_num ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
)


def _r(x: str, name: str, digits: int | None = None) -> str:
    return f"round_even({x}, {_places(name) if digits is None else digits}) + 0.0 AS {name}"


_CALENDAR = f"""
       CAST(day(date) AS INTEGER) AS day_of_month, CAST(dayofyear(date) AS INTEGER) AS day_of_year,
       CAST(week(date) AS INTEGER) AS week_of_year, CAST(quarter(date) AS INTEGER) AS quarter,
       CASE WHEN wday <= 2 THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN day(date) = 1 THEN 1 ELSE 0 END AS is_month_start,
       CASE WHEN date = last_day(date) THEN 1 ELSE 0 END AS is_month_end,
       {_r('sin(2 * pi() * month / 12)', 'month_sin')}, {_r('cos(2 * pi() * month / 12)', 'month_cos')},
       {_r('sin(2 * pi() * wday / 7)', 'wday_sin')}, {_r('cos(2 * pi() * wday / 7)', 'wday_cos')},
       CASE WHEN event_type_1 <> 'None' THEN 1 ELSE 0 END AS has_event1,
       CASE WHEN event_type_2 <> 'None' THEN 1 ELSE 0 END AS has_event2,
       CASE WHEN event_type_1 <> 'None' OR event_type_2 <> 'None' THEN 1 ELSE 0 END AS has_any_event"""
_EVENTS = ", ".join(
    f"CASE WHEN event_type_1 = '{e}' OR event_type_2 = '{e}' THEN 1 ELSE 0 END AS event_{e.lower()}"
    for e in settings.EVENT_TYPES
)


def _over_dense(columns: str) -> str:
    return sql.dense(f"SELECT store_id, item_id, day_num, {columns} FROM dense")


def _over_panel(columns: str) -> str:
    return sql.panel(f"SELECT store_id, item_id, day_num, {columns} FROM panel")


def _windows(template: str, suffix: str) -> str:
    return ", ".join(
        _r(template.format(w=_prev(n)), f"sales_r{n}_{suffix}") if suffix in ("mean", "std", "median")
        else f"CAST({template.format(w=_prev(n))} AS DOUBLE) AS sales_r{n}_{suffix}"
        for n in settings.WINDOWS
    )


def _ratio(a: str, b: str, default: int) -> str:
    return f"coalesce(({a}) / nullif({b}, 0), {default})"


_STREAK = f"""
counted AS (
  SELECT *, row_number() OVER {_W} AS rn FROM dense
),
streaks AS (
  SELECT *, rn - 1 - coalesce(max(CASE WHEN sales <> 0 THEN rn END) OVER {_ALL_PREV}, 0) AS zero_streak,
         coalesce(CASE WHEN sales > 0 THEN day_num - max(CASE WHEN sales > 0 THEN day_num END) OVER {_ALL_PREV} END, 999)
           AS days_since_sale
  FROM counted
)"""

_MEANS = """
store_means AS (SELECT store_id, avg(sales) AS store_avg_sales FROM dense GROUP BY 1),
cat_means AS (SELECT cat_id, avg(sales) AS cat_avg_sales FROM dense GROUP BY 1),
item_means AS (SELECT item_id, avg(sales) AS item_avg_sales FROM dense GROUP BY 1)"""
_MEAN_JOINS = "JOIN store_means USING (store_id) JOIN cat_means USING (cat_id) JOIN item_means USING (item_id)"



_CODES = """
codes AS (
  SELECT store_id, item_id,
         CAST(dense_rank() OVER (ORDER BY store_id) - 1 AS INTEGER) AS store_id_enc,
         CAST(dense_rank() OVER (ORDER BY item_id) - 1 AS INTEGER) AS item_id_enc,
         CAST(dense_rank() OVER (ORDER BY dept_id) - 1 AS INTEGER) AS dept_id_enc,
         CAST(dense_rank() OVER (ORDER BY cat_id) - 1 AS INTEGER) AS cat_id_enc,
         CAST(dense_rank() OVER (ORDER BY state_id) - 1 AS INTEGER) AS state_id_enc
  FROM series
),
weekday_codes AS (
  SELECT day_num, CAST(dense_rank() OVER (ORDER BY weekday) - 1 AS INTEGER) AS weekday_enc FROM calendar
)"""

_SNAP = "CASE a.state_id WHEN 'AFRICA' THEN snap_CA WHEN 'AMERICA' THEN snap_TX WHEN 'ASIA' THEN snap_WI ELSE 0 END"
_PRICE_LAG = f"lag(sell_price, 1) OVER {_W}"
_PRICE_TOP = f"max(sell_price) OVER {_prev(28)}"
_PRICE_7 = f"lag(sell_price, 7) OVER {_W}"

_EXPRESSIONS = {
    **{f"sales_lag_{n}": f"lag(sales, {n}) OVER {_W}" for n in settings.LAGS},
    **{f"sales_r{n}_mean": f"avg(sales) OVER {_prev(n)}" for n in settings.WINDOWS},
    **{f"sales_r{n}_std": f"coalesce(stddev_samp(sales) OVER {_prev(n)}, 0)" for n in settings.WINDOWS},
    **{f"sales_r{n}_min": f"min(sales) OVER {_prev(n)}" for n in settings.WINDOWS},
    **{f"sales_r{n}_max": f"max(sales) OVER {_prev(n)}" for n in settings.WINDOWS},
    **{f"sales_r{n}_median": f"quantile_cont(sales, 0.5) OVER {_prev(n)}" for n in settings.WINDOWS},
    "sales_expanding_mean": f"avg(sales) OVER {_ALL_PREV}",
    "price_change": f"sell_price - {_PRICE_LAG}",
    "price_change_pct": _ratio(f"sell_price - {_PRICE_LAG}", _PRICE_LAG, 0),
    "price_r7_mean": f"avg(sell_price) OVER {_prev(7)}",
    "price_r7_std": f"coalesce(stddev_samp(sell_price) OVER {_prev(7)}, 0)",
    "price_r28_mean": f"avg(sell_price) OVER {_prev(28)}",
    "price_r28_std": f"coalesce(stddev_samp(sell_price) OVER {_prev(28)}, 0)",
    "discount": _ratio(f"sell_price - {_PRICE_TOP}", _PRICE_TOP, 0),
    "price_momentum": _ratio(f"sell_price - {_PRICE_7}", _PRICE_7, 0),
}
_SERIES_SQL = ", ".join(f"{x} AS {name}" for name, x in _EXPRESSIONS.items())
_SUMS = ", ".join(
    _r(
        f"{'max' if c in FRACTIONAL else 'sum'}(coalesce(CAST({c} AS DOUBLE), 0))", c,
        _places(c) if c in FRACTIONAL else 4,
    )
    for c in settings.FEATURE_COLUMNS
)

_FEATURES = f"""
{_MEANS},{_CODES},{_STREAK},
full_calendar AS (SELECT *, {_CALENDAR}, {_EVENTS} FROM calendar),
along AS (SELECT *, {_SERIES_SQL} FROM panel),
everything AS (
  SELECT a.*, f.* EXCLUDE (day_num, date, wm_yr_wk, weekday, wday, month, year, event_name_1, event_type_1,
                           event_name_2, event_type_2, snap_CA, snap_TX, snap_WI),
         s.zero_streak, s.days_since_sale, c.* EXCLUDE (store_id, item_id), w.weekday_enc,
         store_avg_sales, cat_avg_sales, item_avg_sales,
         a.sales - store_avg_sales AS sales_vs_store_avg, a.sales - cat_avg_sales AS sales_vs_cat_avg,
         sell_price * has_any_event AS price_x_event, is_weekend * sales_lag_7 AS weekend_x_lag7,
         {_SNAP.replace('snap_', 'a.snap_')} AS snap,
         ({_SNAP.replace('snap_', 'a.snap_')}) * sell_price AS snap_x_price,
         {_ratio('sales_r7_mean', 'sales_r28_mean', 1)} AS trend_7_28,
         CASE WHEN a.day_num > (SELECT max(day_num) FROM days) - 28 THEN 'val' ELSE 'train' END AS split
  FROM along a JOIN full_calendar f ON a.day_num = f.day_num
  JOIN streaks s ON a.store_id = s.store_id AND a.item_id = s.item_id AND a.day_num = s.day_num
  JOIN codes c ON a.store_id = c.store_id AND a.item_id = c.item_id
  JOIN weekday_codes w ON a.day_num = w.day_num
  JOIN store_means sm ON a.store_id = sm.store_id JOIN cat_means cm ON a.cat_id = cm.cat_id
  JOIN item_means im ON a.item_id = im.item_id
)"""

ORACLES = {
    "calendar_features": sql.dense(f"SELECT day_num, {_CALENDAR}, {_EVENTS} FROM calendar"),
    "weekend_flag": sql.dense(
        "SELECT date, wday, CASE WHEN wday <= 2 THEN 1 ELSE 0 END AS is_weekend FROM calendar"
    ),
    "event_flags": _over_panel(_EVENTS),
    "sales_lags": _over_dense(
        ", ".join(f"CAST({_EXPRESSIONS[c]} AS DOUBLE) AS {c}" for c in settings.LAG_FEATURES)
    ),
    "rolling_mean": _over_dense(_windows("avg(sales) OVER {w}", "mean")),
    "rolling_std": _over_dense(_windows("coalesce(stddev_samp(sales) OVER {w}, 0)", "std")),
    "rolling_min": _over_dense(_windows("min(sales) OVER {w}", "min")),
    "rolling_max": _over_dense(_windows("max(sales) OVER {w}", "max")),
    "rolling_median": _over_dense(_windows("quantile_cont(sales, 0.5) OVER {w}", "median")),
    "expanding_mean": _over_dense(_r(f"avg(sales) OVER {_ALL_PREV}", "sales_expanding_mean")),
    **{
        query: _over_panel(", ".join(_r(_EXPRESSIONS[c], c) for c in columns))
        for query, columns in {
            "price_changes": ["price_change", "price_change_pct"],
            "price_rolling_mean": ["price_r7_mean", "price_r28_mean"],
            "price_rolling_std": ["price_r7_std", "price_r28_std"],
            "price_discount": ["discount"],
            "price_momentum": ["price_momentum"],
        }.items()
    },
    "label_codes": f"WITH {sql.LINES},{sql.CELLS},{sql.days(None)},{sql.DENSE},{_CODES}" + """
SELECT store_id, item_id, day_num, store_id_enc, item_id_enc, dept_id_enc, cat_id_enc, state_id_enc, weekday_enc
FROM dense JOIN codes USING (store_id, item_id) JOIN weekday_codes USING (day_num)""",
    "group_averages": f"WITH {sql.LINES},{sql.CELLS},{sql.days(None)},{sql.DENSE},{_MEANS}" + f"""
SELECT store_id, item_id, day_num, {_r('store_avg_sales', 'store_avg_sales')},
       {_r('cat_avg_sales', 'cat_avg_sales')}, {_r('item_avg_sales', 'item_avg_sales')}
FROM dense {_MEAN_JOINS}""",
    "relative_sales": f"WITH {sql.LINES},{sql.CELLS},{sql.days(None)},{sql.DENSE},{_MEANS}" + f"""
SELECT store_id, item_id, day_num, {_r('sales - store_avg_sales', 'sales_vs_store_avg')},
       {_r('sales - cat_avg_sales', 'sales_vs_cat_avg')}
FROM dense {_MEAN_JOINS}""",
    "zero_streak": f"WITH {sql.LINES},{sql.CELLS},{sql.days(None)},{sql.DENSE},{_STREAK}" + """
SELECT store_id, item_id, day_num, CAST(zero_streak AS INTEGER) AS zero_streak FROM streaks""",
    "days_since_sale": f"WITH {sql.LINES},{sql.CELLS},{sql.days(None)},{sql.DENSE},{_STREAK}" + """
SELECT store_id, item_id, day_num, CAST(days_since_sale AS INTEGER) AS days_since_sale FROM streaks""",
    "interactions": sql.panel(f"""
SELECT store_id, item_id, day_num,
       {_r("CASE WHEN event_type_1 <> 'None' OR event_type_2 <> 'None' THEN sell_price ELSE 0 END", 'price_x_event')},
       CAST(CASE WHEN wday <= 2 THEN 1 ELSE 0 END * lag(sales, 7) OVER {_W} AS DOUBLE) AS weekend_x_lag7,
       {_SNAP} AS snap, {_r(f'({_SNAP}) * sell_price', 'snap_x_price')},
       {_r(_ratio(f'avg(sales) OVER {_prev(7)}', f'avg(sales) OVER {_prev(28)}', 1), 'trend_7_28')}
FROM panel a"""),
    "feature_table": sql.panel(f"""
SELECT store_id, item_id, split, count(*) AS n_rows, {_SUMS} FROM everything GROUP BY ALL""",
        ctes=_FEATURES),
    "feature_list": sql.panel(
        "SELECT unnest(names) AS feature, unnest(counts) AS n_values FROM (SELECT ["
        + ", ".join(f"'{c}'" for c in settings.FEATURE_COLUMNS) + "] AS names, ["
        + ", ".join(f"count({c})" for c in settings.FEATURE_COLUMNS) + "] AS counts FROM everything)",
        ctes=_FEATURES),
    "warm_up_dropped": sql.panel(f"""
SELECT store_id, item_id, split, count(*) AS n_rows, min(day_num) AS first_day,
       CAST(sum(coalesce(lag56, 0)) AS BIGINT) AS sum_lag_56
FROM (SELECT *, lag(sales, 56) OVER {_W} AS lag56,
             CASE WHEN day_num > (SELECT max(day_num) FROM days) - 28 THEN 'val' ELSE 'train' END AS split
      FROM panel)
WHERE split = 'val' OR lag56 IS NOT NULL GROUP BY ALL"""),
    "event_type_lags": """
WITH cells AS (
  SELECT event_type, user_id % 10 AS user_group, CAST(ts AS DATE) - DATE '2024-01-01' + 1 AS day, count(*) AS hits
  FROM events GROUP BY ALL
),
series AS (SELECT DISTINCT event_type, user_group FROM cells),
days AS (SELECT unnest(generate_series(1, (SELECT max(day) FROM cells))) AS day),
dense AS (
  SELECT s.event_type, s.user_group, d.day, coalesce(c.hits, 0) AS hits
  FROM series s CROSS JOIN days d LEFT JOIN cells c USING (event_type, user_group, day)
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY event_type, user_group ORDER BY day) AS rn FROM dense)
SELECT event_type, user_group, CAST(day AS INTEGER) AS day, CAST(hits AS DOUBLE) AS hits,
       CAST(lag(hits, 1) OVER w AS DOUBLE) AS hits_lag_1, CAST(lag(hits, 7) OVER w AS DOUBLE) AS hits_lag_7,
       round_even(avg(hits) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS hits_r7_mean,
       round_even(avg(hits) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 8) AS hits_expanding_mean,
       CAST(rn - 1 - coalesce(max(CASE WHEN hits <> 0 THEN rn END)
         OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS zero_streak
FROM ranked WINDOW w AS (PARTITION BY event_type, user_group ORDER BY day)""",
    "series_in_blocks": f"WITH {sql.LINES},{sql.CELLS},{sql.days(None)},{sql.DENSE},{_STREAK}" + f"""
SELECT store_id, item_id, day_num, CAST(lag(sales, 1) OVER {_W} AS DOUBLE) AS sales_lag_1,
       CAST(lag(sales, 56) OVER {_W} AS DOUBLE) AS sales_lag_56, {_r(f'avg(sales) OVER {_prev(28)}', 'sales_r28_mean')},
       {_r(f'avg(sales) OVER {_ALL_PREV}', 'sales_expanding_mean')},
       CAST(zero_streak AS INTEGER) AS zero_streak, CAST(days_since_sale AS INTEGER) AS days_since_sale
FROM streaks""",
}
