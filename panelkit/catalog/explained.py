"""Queries: model reports over naive predictions, attributions of fixed weights, with SQL twins.

The operators are those that the fitted models use; what they work on here has an exact twin.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.catalog import sql
from panelkit.catalog.analytics import NAIVE_MODELS, _metrics_sql, _naive_predictions
from panelkit.catalog.text import _intent, answered
from panelkit.operators import analytics as A
from panelkit.operators import answers as Q
from panelkit.operators import attribution as E
from panelkit.operators import metrics as M
from panelkit.operators import models as L
from panelkit.settings import SEED
from panelkit.sources import files, trade
from panelkit.storage import new_path, stage

# A made weighted sum over panel columns: weight and center of each.
WEIGHTS = {
    "sell_price": -0.004, "wday": 0.35, "month": -0.125, "year": 0.5, "snap_CA": 1.5, "snap_TX": -0.75,
    "sales": 0.0625,
}
CENTERS = {
    "sell_price": 1400.0, "wday": 4.0, "month": 6.5, "year": 1995.0, "snap_CA": 0.25, "snap_TX": 0.25,
    "sales": 8.0,
}
BASE = 6.0


def _explained(spark, folder):
    return E.explain_weights(trade.panel(spark, folder), WEIGHTS, CENTERS, BASE)


def _latest(spark, folder):
    rows = A.latest_rows(trade.panel(spark, folder).select(*E.KEY, *WEIGHTS))
    return E.explain_weights(rows, WEIGHTS, CENTERS, BASE)


def weight_attributions(spark, folder):
    """One row per series and feature, for the last day."""
    return E.long_form(_latest(spark, folder))


def _ranked(summary, column):
    return summary.select("store_id", "item_id", F.posexplode(column).alias("place", "c")).select(
        "store_id", "item_id", (F.col("place") + 1).alias("place"), "c.feature", "c.impact", "c.value"
    )


def strongest_contributions(spark, folder):
    """The three strongest of each sign."""
    summary = stage(E.summarize(_latest(spark, folder), top=3), "summary")
    up = _ranked(summary, "top_positive").withColumn("sign", F.lit("up"))
    return up.unionByName(_ranked(summary, "top_negative").withColumn("sign", F.lit("down")))


def largest_contributions(spark, folder):
    """The four largest by size, unrounded."""
    return _ranked(E.summarize(_latest(spark, folder), listed=4), "largest")


def weight_waterfall(spark, folder):
    return E.waterfall(E.summarize(_latest(spark, folder)))


def weight_sentences(spark, folder):
    told = E.interpretation(E.summarize(_latest(spark, folder)), 2)
    return told.select("store_id", "item_id", "interpretation")


def weight_importance(spark, folder):
    """Mean size of the contributions over all series and days, ranked."""
    return E.global_importance(_explained(spark, folder))


def explained_series(spark, folder):
    """Questions about items, the sentence attached where the item sells in the store."""
    series = trade.sales_cells(spark, folder).select("store_id", "item_id").distinct()
    asked = series.withColumn("store_id", F.when(F.col("item_id") != "Brand#11", F.col("store_id")).otherwise("NONE"))
    return E.attach_explanations(asked.distinct(), E.summarize(_latest(spark, folder))).select(
        "store_id", "item_id", "prediction", "enriched"
    )


def explained_answers(spark, folder):
    """Answers on every product, with the explanation where it is asked for and the product is known."""
    series = trade.sales_cells(spark, folder).select("store_id", "item_id").distinct()
    questions = series.select(
        F.concat_ws("/", "store_id", "item_id").alias("question_id"),
        F.concat(F.lit("Why does "), "item_id", F.lit(" sell?")).alias("question"),
        F.when(F.col("item_id") != "Brand#11", F.col("store_id")).otherwise("NONE").alias("store_id"), "item_id",
        F.col("store_id").endswith("_1").alias("explain"),
    )
    questions = stage(Q.expand_flagged(questions), "questions")
    answers = answered(spark, folder, questions.select("question_id", "question"))
    told = E.interpretation(E.summarize(_latest(spark, folder)), 2)
    return Q.explain_answers(answers, questions, told).select(
        "question_id", "question", "intent", "enriched", "explanation",
        F.coalesce(F.col("answer").endswith(F.col("explanation")), F.lit(False)).alias("attached"),
    )


def naive_comparison(spark, folder):
    """The predictions of three naive models side by side."""
    return L.compare_predictions(_naive_predictions(spark, folder), models=NAIVE_MODELS)


def naive_sample(spark, folder):
    """Ten validation rows with prediction and error of every naive model."""
    return L.sample_predictions(_naive_predictions(spark, folder), models=NAIVE_MODELS)


def naive_registry(spark, folder):
    """Metadata of the naive models, written, read back and listed with one that is missing."""
    path = new_path(spark, "naive_models")
    errors = M.forecast_errors(_naive_predictions(spark, folder)).select("model", "rmse", "mae", "rmsse")
    files.write_model_metadata(files.model_metadata(errors, ["sales"], {"rows": "val"}), path)
    listed = files.list_models(files.read_model_metadata(spark, path), (*NAIVE_MODELS, "absent"))
    return listed.select(
        "model_name", "status", "n_features", *[F.col("metrics")[m].alias(m) for m in ("rmse", "mae", "rmsse")]
    )


QUERIES = {
    f.__name__: f
    for f in (
        weight_attributions, strongest_contributions, largest_contributions, weight_waterfall,
        weight_sentences, weight_importance, explained_series, explained_answers, naive_comparison, naive_sample, naive_registry,
    )
}


def _impacts(rows: str) -> str:
    one = " UNION ALL ".join(
        f"SELECT store_id, item_id, day_num, '{f}' AS feature, {f}::DOUBLE AS value, "
        f"({f}::DOUBLE - {CENTERS[f]}::DOUBLE) * ({w}::DOUBLE) AS impact FROM {rows}"
        for f, w in WEIGHTS.items()
    )
    total = " + ".join(f"({f}::DOUBLE - {CENTERS[f]}::DOUBLE) * ({w}::DOUBLE)" for f, w in WEIGHTS.items())
    return f"impacts AS ({one}), sums AS (SELECT store_id, item_id, day_num, {BASE} + ({total}) AS prediction FROM {rows})"


_LATEST = "latest AS (SELECT * FROM panel WHERE day_num = (SELECT max(day_num) FROM days))," + _impacts("latest")
_BARS = """
bars AS (
  SELECT store_id, item_id, day_num, feature, round_even(impact, 4) AS impact, round_even(value, 4) AS value,
         CASE WHEN impact > 0 THEN 'up' ELSE 'down' END AS sign,
         row_number() OVER (PARTITION BY store_id, item_id, impact > 0 ORDER BY abs(impact) DESC, feature) AS place
  FROM impacts WHERE impact <> 0
)"""


def _decimal(x: str, digits: int) -> str:
    return f"CAST(CAST(round_even({x}, {digits}) AS DECIMAL(28, {digits})) AS VARCHAR)"


def _listing(sign: str, mark: str) -> str:
    return f"""coalesce((SELECT string_agg(feature || ' ({mark}' || {_decimal('impact', 4)} || ')', ', ' ORDER BY place)
   FROM bars b WHERE b.store_id = s.store_id AND b.item_id = s.item_id AND sign = '{sign}' AND place <= 2), '')"""


_SIDE_BY_SIDE = """
wide AS (
  SELECT store_id, item_id, day_num, sales, max(prediction) FILTER (model = 'last_day') AS last_day,
         max(prediction) FILTER (model = 'last_week') AS last_week, max(prediction) FILTER (model = 'mean_28') AS mean_28
  FROM predictions GROUP BY ALL
)"""

ORACLES = {
    "weight_attributions": sql.panel(
        "SELECT store_id, item_id, day_num, 'weights' AS model, feature, value, impact FROM impacts", ctes=_LATEST
    ),
    "strongest_contributions": sql.panel(
        "SELECT store_id, item_id, CAST(place AS INTEGER) AS place, feature, impact, value, sign FROM bars WHERE place <= 3",
        ctes=f"{_LATEST},{_BARS}",
    ),
    "largest_contributions": sql.panel("""
SELECT store_id, item_id, CAST(place AS INTEGER) AS place, feature, impact, value FROM (
  SELECT *, row_number() OVER (PARTITION BY store_id, item_id ORDER BY abs(impact) DESC, feature) AS place FROM impacts
) WHERE place <= 4""", ctes=_LATEST),
    "weight_waterfall": sql.panel("""
SELECT store_id, item_id, day_num,
       CAST(row_number() OVER (PARTITION BY store_id, item_id ORDER BY impact, feature) - 1 AS INTEGER) AS position,
       feature, impact, CASE WHEN impact > 0 THEN 'positive' ELSE 'negative' END AS type
FROM bars WHERE place <= 5""", ctes=f"{_LATEST},{_BARS}"),
    "weight_sentences": sql.panel(f"""
SELECT store_id, item_id, {_decimal('round_even(prediction, 4)', 2)} || ' units are predicted. Raised by: '
       || {_listing('up', '+')} || '; lowered by: ' || {_listing('down', '')} || '.' AS interpretation
FROM sums s""", ctes=f"{_LATEST},{_BARS}"),
    "weight_importance": sql.panel("""
SELECT CAST(row_number() OVER (ORDER BY round_even(size, 6) DESC, feature) AS INTEGER) AS rank, feature,
       round_even(size, 6) AS mean_abs_shap
FROM (SELECT feature, avg(abs(impact)) AS size FROM impacts GROUP BY 1)""", ctes=_impacts("panel")),
    "explained_series": sql.panel("""
SELECT a.store_id, a.item_id, round_even(prediction, 4) AS prediction, prediction IS NOT NULL AS enriched
FROM (SELECT DISTINCT CASE WHEN item_id <> 'Brand#11' THEN store_id ELSE 'NONE' END AS store_id, item_id FROM series) a
LEFT JOIN sums s ON s.store_id = a.store_id AND s.item_id = a.item_id""", ctes=_LATEST),
    "explained_answers": sql.panel(f"""
SELECT question_id, question, {_intent('question')} AS intent, interpretation IS NOT NULL AS enriched,
       interpretation AS explanation, interpretation IS NOT NULL AS attached
FROM (
  SELECT store_id || '/' || item_id AS question_id, item_id,
         CASE WHEN item_id <> 'Brand#11' THEN store_id ELSE 'NONE' END AS store_id, ends_with(store_id, '_1') AS explain,
         'Why does ' || item_id || ' sell?' || CASE WHEN ends_with(store_id, '_1') THEN
           ' store ' || CASE WHEN item_id <> 'Brand#11' THEN store_id ELSE 'NONE' END || ' product ' || item_id ELSE '' END AS question
  FROM (SELECT DISTINCT store_id, item_id FROM series)
) q
LEFT JOIN told t ON q.explain AND t.store_id = q.store_id AND t.item_id = q.item_id""", ctes=f"{_LATEST},{_BARS}," + f"""
told AS (
  SELECT store_id, item_id, {_decimal('round_even(prediction, 4)', 2)} || ' units are predicted. Raised by: '
         || {_listing('up', '+')} || '; lowered by: ' || {_listing('down', '')} || '.' AS interpretation
  FROM sums s)"""),
    "naive_comparison": _metrics_sql("SELECT * FROM wide").replace("errors AS (", f"{_SIDE_BY_SIDE.strip()},\nerrors AS (", 1),
    "naive_sample": _metrics_sql(f"""
SELECT *, abs(last_day - sales) AS last_day_error, abs(last_week - sales) AS last_week_error, abs(mean_28 - sales) AS mean_28_error
FROM wide ORDER BY md5('{SEED}:' || store_id || ':' || item_id || ':' || CAST(day_num AS VARCHAR)), store_id, item_id, day_num
LIMIT 10""").replace("errors AS (", f"{_SIDE_BY_SIDE.strip()},\nerrors AS (", 1),
    "naive_registry": _metrics_sql("""
SELECT model_name, CASE WHEN rmse IS NULL THEN 'not_available' ELSE 'loaded' END AS status,
       CASE WHEN rmse IS NOT NULL THEN 1 END AS n_features, rmse, mae, rmsse
FROM (VALUES ('last_day'), ('last_week'), ('mean_28'), ('absent')) n(model_name) LEFT JOIN metrics ON model = model_name"""),
}
