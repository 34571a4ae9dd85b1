"""Queries: sources, panel building, quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit import settings
from panelkit.catalog import sql
from panelkit.functions.columns import day_number
from panelkit.operators import panel as P
from panelkit.operators import split as S
from panelkit.plans.features import build_panel
from panelkit.sources import files, quality, schemas, trade
from panelkit.storage import new_path


def _wide(spark: SparkSession, folder: str) -> DataFrame:
    """The wide form of the dense panel, over its whole history: one column per day."""
    first, last = trade.shipping_days(spark, folder)
    dense = P.densify(trade.sales_cells(spark, folder), first, last)
    in_order = F.sort_array(F.collect_list(F.struct("day_num", "sales")))
    ids = ("item_id", "dept_id", "cat_id", "store_id", "state_id")
    rows = dense.groupBy(*ids).agg(in_order["sales"].alias("s"))
    return rows.selectExpr(
        "concat_ws('_', item_id, store_id) AS id", *ids,
        *[f"int(s[{d - first}]) AS d_{d}" for d in range(first, last + 1)],
    )


def _calendar(spark: SparkSession, folder: str) -> DataFrame:
    return trade.calendar(spark, *trade.shipping_days(spark, folder))


def _calendar_csv(spark: SparkSession, folder: str) -> str:
    path = new_path(spark, "calendar_csv")
    days = _calendar(spark, folder)
    files.write_csv(
        days.select(F.concat(F.lit("d_"), "day_num").alias("d"),
                    *[c for c in days.columns if c != "day_num"]),
        path,
    )
    return path


def _prices_csv(spark: SparkSession, folder: str) -> str:
    path = new_path(spark, "prices_csv")
    files.write_csv(trade.week_prices(spark, folder), path)
    return path


def _wide_csv(spark: SparkSession, folder: str) -> str:
    path = new_path(spark, "wide_csv")
    files.write_csv(_wide(spark, folder), path)
    return path


def wide_sales_csv(spark, folder):
    """Read wide sales from CSV, as one row per series with its total and number of days."""
    wide = files.read_wide_sales(spark, _wide_csv(spark, folder))
    days = P.day_columns(wide)
    return wide.select(
        "id", "item_id", "dept_id", "cat_id", "store_id", "state_id",
        F.lit(len(days)).cast("long").alias("n_days"),
        F.aggregate(F.array(*days), F.lit(0).cast("long"), lambda a, x: a + x).alias("total_sales"),
    )


def item_categories_csv(spark, folder):
    return files.read_item_categories(spark, _wide_csv(spark, folder)).distinct()


def calendar_csv(spark, folder):
    return files.read_calendar(spark, _calendar_csv(spark, folder))


def prices_csv(spark, folder):
    return files.read_prices(spark, _prices_csv(spark, folder))


def panel_parquet(spark, folder):
    """Write the panel by store, read it back."""
    path = new_path(spark, "panel")
    files.write_panel(trade.panel(spark, folder), path)
    return files.read_panel(spark, path).select(trade.panel_columns())


def melt_wide_sales(spark, folder):
    return P.melt_days(_wide(spark, folder)).drop("id").withColumn("sales", F.col("sales").cast("long"))


def day_numbers(spark, folder):
    days = _calendar(spark, folder).select(F.concat(F.lit("d_"), "day_num").alias("d"))
    return days.select("d", day_number("d").alias("day_num"))


def dense_sales(spark, folder):
    return trade.dense_sales(spark, folder)


def sampled_item_sales(spark, folder):
    """Sales cells of the sampled items only."""
    cells = trade.sales_cells(spark, folder)
    return P.keep_items(cells, P.sample_items(cells, target=12))


def last_500_days(spark, folder):
    return P.keep_last_days(trade.dense_sales(spark, folder), settings.HISTORY_DAYS)


def events_filled(spark, folder):
    return P.fill_events(_calendar(spark, folder))


def calendar_join(spark, folder):
    dense = trade.dense_sales(spark, folder)
    joined = P.join_calendar(dense, _calendar(spark, folder))
    return joined.select("store_id", "item_id", "day_num", "sales", "date", "wm_yr_wk", "weekday")


def price_join(spark, folder):
    dense = trade.dense_sales(spark, folder).withColumn(
        "wm_yr_wk", trade.week_of(F.col("day_num"))
    )
    joined = P.join_prices(dense, trade.week_prices(spark, folder))
    return joined.select("store_id", "item_id", "day_num", "wm_yr_wk", "sales", "sell_price")


def price_fill(spark, folder):
    return trade.panel(spark, folder).select("store_id", "item_id", "day_num", "sell_price")


def items_per_category(spark, folder):
    return P.items_per_category(trade.sales_cells(spark, folder))


def stratified_items(spark, folder):
    return P.sample_items(trade.sales_cells(spark, folder), target=12)


def stratified_item_counts(spark, folder):
    sample = P.sample_items(trade.sales_cells(spark, folder))
    return P.sampled_per_category(sample)


def distinct_sampled_items(spark, folder):
    return P.distinct_items(P.sample_items(trade.sales_cells(spark, folder), target=12))


def panel_profile(spark, folder):
    return quality.panel_profile(trade.panel(spark, folder))


def schema_check(spark, folder):
    """Violations of a deliberately stricter schema by the order lines."""
    from pyspark.sql import types as T

    expected = T.StructType([
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_quantity", T.IntegerType()),
        T.StructField("l_store", T.StringType()),
    ])
    lines = trade.table(spark, folder, "lineitem")
    declared = quality.schema_violations(lines, expected)
    nulls = quality.required_value_violations(lines, ["l_orderkey", "l_partkey", "l_shipdate"])
    return declared.select(
        "column", "problem", F.lit(0).cast("long").alias("null_rows")
    ).unionByName(nulls.select("column", F.lit("nulls").alias("problem"), "null_rows"))


def _repeated_prices(spark, folder):
    """Daily unit prices: an exact copy of every row, and real conflicts on busy days."""
    lines = trade.order_lines(spark, folder)
    rows = lines.select("p_brand", "r_name", "day_num", "units")
    return rows.unionAll(rows)


def exact_duplicates(spark, folder):
    return quality.drop_exact_duplicates(_repeated_prices(spark, folder))


def conflicting_keys(spark, folder):
    return quality.conflicting_keys(
        _repeated_prices(spark, folder), key=("p_brand", "r_name", "day_num")
    )


def panel_from_files(spark, folder):
    """The whole way: wide, calendar and price files to the dense panel of all days."""
    built = build_panel(
        files.read_wide_sales(spark, _wide_csv(spark, folder)),
        files.read_calendar(spark, _calendar_csv(spark, folder)),
        files.read_prices(spark, _prices_csv(spark, folder)),
    )
    return built.withColumn("sales", F.col("sales").cast("long")).select(trade.panel_columns())


def split_marks(spark, folder):
    dense = trade.dense_sales(spark, folder)
    return S.mark_split(dense).select("store_id", "item_id", "day_num", "sales", "split")


QUERIES = {
    f.__name__: f
    for f in (
        wide_sales_csv, item_categories_csv, calendar_csv, prices_csv, panel_parquet,
        melt_wide_sales, day_numbers, dense_sales, sampled_item_sales, last_500_days,
        events_filled, calendar_join, price_join, price_fill, items_per_category,
        stratified_items, stratified_item_counts, distinct_sampled_items, panel_profile,
        schema_check, exact_duplicates, conflicting_keys, panel_from_files, split_marks,
    )
}

_PANEL_COLUMNS = ", ".join(
    f.name for f in schemas.PANEL.fields if f.name != "id"
)


def _sample_ctes(target: int, minimum: int = settings.SAMPLE_MINIMUM) -> str:
    return f""",
items AS (SELECT DISTINCT cat_id, item_id FROM cells),
counts AS (SELECT cat_id, count(*) AS n FROM items GROUP BY 1),
quota AS (
  SELECT cat_id, least(n, greatest({minimum}, CAST(floor({target} * n / (SELECT sum(n) FROM counts)) AS BIGINT))) AS q
  FROM counts
),
sample AS (
  SELECT cat_id, item_id FROM (
    SELECT *, row_number() OVER (PARTITION BY cat_id ORDER BY md5('{settings.SEED}:' || item_id), item_id) AS rn
    FROM items) JOIN quota USING (cat_id) WHERE rn <= q
)"""


ORACLES = {
    "wide_sales_csv": sql.dense("""
SELECT item_id || '_' || store_id AS id, item_id, dept_id, cat_id, store_id, state_id,
       count(*) AS n_days, CAST(sum(sales) AS BIGINT) AS total_sales
FROM dense GROUP BY ALL"""),
    "item_categories_csv": sql.cells("SELECT DISTINCT item_id, cat_id FROM cells"),
    "calendar_csv": sql.dense("SELECT * FROM raw_calendar"),
    "prices_csv": f"WITH {sql.LINES},{sql.PRICES} SELECT * FROM prices",
    "panel_parquet": sql.panel(f"SELECT {_PANEL_COLUMNS} FROM panel"),
    "melt_wide_sales": sql.dense("SELECT * FROM dense"),
    "day_numbers": sql.dense("SELECT 'd_' || CAST(day_num AS VARCHAR) AS d, day_num FROM days"),
    "dense_sales": sql.dense("SELECT * FROM dense"),
    "sampled_item_sales": sql.cells("").rstrip() + _sample_ctes(12) + """
SELECT * FROM cells WHERE item_id IN (SELECT item_id FROM sample)""",
    "last_500_days": sql.dense("""
SELECT * FROM dense WHERE day_num > (SELECT max(day_num) FROM dense) - 500"""),
    "events_filled": sql.dense("SELECT * FROM calendar"),
    "calendar_join": sql.dense("""
SELECT store_id, item_id, d.day_num, sales, date, wm_yr_wk, weekday
FROM dense d LEFT JOIN raw_calendar c ON d.day_num = c.day_num"""),
    "price_join": f"WITH {sql.LINES},{sql.CELLS},{sql.PRICES},{sql.days(None)},{sql.DENSE}" + """
SELECT d.store_id, d.item_id, d.day_num, c.wm_yr_wk, d.sales, p.sell_price
FROM dense d JOIN calendar c ON d.day_num = c.day_num
LEFT JOIN prices p ON d.store_id = p.store_id AND d.item_id = p.item_id AND c.wm_yr_wk = p.wm_yr_wk""",
    "price_fill": sql.panel("SELECT store_id, item_id, day_num, sell_price FROM panel"),
    "items_per_category": sql.cells(
        "SELECT cat_id, count(DISTINCT item_id) AS n_items FROM cells GROUP BY 1"
    ),
    "stratified_items": sql.cells("").rstrip() + _sample_ctes(12) + "\nSELECT * FROM sample",
    "stratified_item_counts": sql.cells("").rstrip() + _sample_ctes(settings.SAMPLE_ITEMS)
    + "\nSELECT cat_id, count(*) AS n_sampled FROM sample GROUP BY 1",
    "distinct_sampled_items": sql.cells("").rstrip() + _sample_ctes(12)
    + "\nSELECT DISTINCT item_id FROM sample",
    "panel_profile": sql.panel("""
SELECT count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date,
       min(sales) AS min_sales, max(sales) AS max_sales,
       count(DISTINCT item_id) AS n_items, count(DISTINCT store_id) AS n_stores,
       count(*) FILTER (sell_price IS NULL) AS null_prices
FROM panel"""),
    "schema_check": """
SELECT 'l_quantity' AS "column", 'type' AS problem, CAST(0 AS BIGINT) AS null_rows
UNION ALL SELECT 'l_store', 'missing', 0
UNION ALL SELECT 'l_orderkey', 'nulls', count(*) FILTER (l_orderkey IS NULL) FROM lineitem
UNION ALL SELECT 'l_partkey', 'nulls', count(*) FILTER (l_partkey IS NULL) FROM lineitem
UNION ALL SELECT 'l_shipdate', 'nulls', count(*) FILTER (l_shipdate IS NULL) FROM lineitem""",
    "exact_duplicates": f"WITH {sql.LINES}" + """
SELECT DISTINCT item_id AS p_brand, replace(state_id, '_', ' ') AS r_name, day_num, units FROM lines""",
    "conflicting_keys": f"WITH {sql.LINES}" + """
SELECT p_brand, r_name, day_num, count(*) AS n_rows FROM (
  SELECT DISTINCT item_id AS p_brand, replace(state_id, '_', ' ') AS r_name, day_num, units FROM lines)
GROUP BY ALL HAVING count(*) > 1""",
    "panel_from_files": sql.panel(f"SELECT {_PANEL_COLUMNS} FROM panel"),
    "split_marks": sql.dense("""
SELECT store_id, item_id, day_num, sales,
       CASE WHEN day_num >= (SELECT max(day_num) FROM dense) - 27 THEN 'val' ELSE 'train' END AS split
FROM dense"""),
}
