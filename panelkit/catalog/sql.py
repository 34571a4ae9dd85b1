"""Shared SQL: the panel of `panelkit.sources.trade`, written for DuckDB."""

from __future__ import annotations

LINES = """
lines AS (
  SELECT replace(r_name, ' ', '_') || '_' || CAST(s_suppkey % 2 + 1 AS VARCHAR) AS store_id,
         p_brand AS item_id,
         'CAT_' || CAST(bn % 3 AS VARCHAR) || '_' || CAST(bn % 2 + 1 AS VARCHAR) AS dept_id,
         'CAT_' || CAST(bn % 3 AS VARCHAR) AS cat_id,
         replace(r_name, ' ', '_') AS state_id,
         CAST(l_shipdate AS DATE) - DATE '1995-01-02' + 1 AS day_num,
         CAST(l_quantity AS BIGINT) AS units,
         CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS cents
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN (SELECT *, CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) AS bn FROM part) p
    ON l_partkey = p_partkey
)"""

CELLS = """
cells AS (
  SELECT store_id, item_id, dept_id, cat_id, state_id, day_num, CAST(sum(units) AS BIGINT) AS sales
  FROM lines GROUP BY ALL
),
series AS (SELECT DISTINCT store_id, item_id, dept_id, cat_id, state_id FROM cells)"""

PRICES = """
prices AS (
  SELECT store_id, item_id, CAST(floor((day_num - 1) / 7) AS INTEGER) AS wm_yr_wk,
         CAST((2 * sum(cents) + sum(units)) // (2 * sum(units)) AS DOUBLE) / 100.0 AS sell_price
  FROM lines GROUP BY ALL
)"""


def days(history: int | None) -> str:
    first = (
        "min(day_num)" if history is None
        else f"greatest(min(day_num), max(day_num) - {history} + 1)"
    )
    return f"""
days AS (
  SELECT CAST(unnest(generate_series(lo, hi)) AS INTEGER) AS day_num
  FROM (SELECT {first} AS lo, max(day_num) AS hi FROM lines)
),
dated AS (SELECT day_num, CAST(DATE '1995-01-01' + day_num AS DATE) AS date FROM days),
raw_calendar AS (
  SELECT day_num, date,
         CAST(floor((day_num - 1) / 7) AS INTEGER) AS wm_yr_wk,
         dayname(date) AS weekday,
         CAST((dayofweek(date) + 1) % 7 + 1 AS INTEGER) AS wday,
         CAST(month(date) AS INTEGER) AS month,
         CAST(year(date) AS INTEGER) AS year,
         CASE WHEN strftime(date, '%m-%d') = '12-25' THEN 'Christmas'
              WHEN strftime(date, '%m-%d') = '07-04' THEN 'IndependenceDay'
              WHEN strftime(date, '%m-%d') = '10-31' THEN 'Halloween'
              WHEN month(date) = 2 AND day(date) <= 7 AND dayofweek(date) = 0 THEN 'SuperBowl'
              WHEN strftime(date, '%m-%d') = '09-01' THEN 'LaborDay' END AS event_name_1,
         CASE WHEN strftime(date, '%m-%d') = '12-25' THEN 'Religious'
              WHEN strftime(date, '%m-%d') = '07-04' THEN 'National'
              WHEN strftime(date, '%m-%d') = '10-31' THEN 'Cultural'
              WHEN month(date) = 2 AND day(date) <= 7 AND dayofweek(date) = 0 THEN 'Sporting'
              WHEN strftime(date, '%m-%d') = '09-01' THEN 'Federal' END AS event_type_1,
         CASE WHEN strftime(date, '%m-%d') = '12-25' THEN 'WinterFair' END AS event_name_2,
         CASE WHEN strftime(date, '%m-%d') = '12-25' THEN 'Cultural' END AS event_type_2,
         CASE WHEN day(date) <= 10 THEN 1 ELSE 0 END AS snap_CA,
         CASE WHEN day(date) <= 15 AND day(date) % 2 = 1 THEN 1 ELSE 0 END AS snap_TX,
         CASE WHEN day(date) <= 15 AND day(date) % 2 = 0 THEN 1 ELSE 0 END AS snap_WI
  FROM dated
),
calendar AS (
  SELECT * REPLACE (coalesce(event_name_1, 'None') AS event_name_1,
                    coalesce(event_type_1, 'None') AS event_type_1,
                    coalesce(event_name_2, 'None') AS event_name_2,
                    coalesce(event_type_2, 'None') AS event_type_2)
  FROM raw_calendar
)"""


DENSE = """
dense AS (
  SELECT s.*, d.day_num, coalesce(c.sales, 0) AS sales
  FROM series s CROSS JOIN days d
  LEFT JOIN cells c USING (store_id, item_id, day_num)
)"""

PANEL = """
priced AS (
  SELECT d.store_id, d.item_id, d.dept_id, d.cat_id, d.state_id, d.sales, c.*, p.sell_price
  FROM dense d JOIN calendar c USING (day_num)
  LEFT JOIN prices p USING (store_id, item_id, wm_yr_wk)
),
panel AS (
  SELECT * REPLACE (coalesce(sell_price,
           median(sell_price) OVER (PARTITION BY store_id, item_id), 0) AS sell_price)
  FROM priced
)"""


def cells(body: str) -> str:
    return f"WITH {LINES},{CELLS}\n{body}"


def dense(body: str, history: int | None = None) -> str:
    return f"WITH {LINES},{CELLS},{days(history)},{DENSE}\n{body}"


def panel_ctes(history: int | None = None) -> str:
    return f"{LINES},{CELLS},{PRICES},{days(history)},{DENSE},{PANEL}"


def panel(body: str, history: int | None = None, ctes: str = "") -> str:
    """A statement over the panel; `ctes` adds further common table expressions."""
    more = f",{ctes}" if ctes else ""
    return f"WITH {panel_ctes(history)}{more}\n{body}"
