"""Queries: models, forecasts, attributions. Rows-only: the fits have no SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit import settings
from panelkit.catalog.inventory import _positions
from panelkit.operators import analytics as A
from panelkit.operators import attribution as E
from panelkit.operators import inventory as I
from panelkit.operators import metrics as M
from panelkit.operators import models as L
from panelkit.plans.features import trade_features
from panelkit.sources import files, trade
from panelkit.storage import new_path, stage

# The newest days whose rows the models are fitted on: a bound on labelled rows, nothing else. Features,
# averages, and history and deviations next to the forecasts are taken over all days.
FIT_DAYS = settings.HISTORY_DAYS

_cache: dict = {}


def _once(spark, folder, name, make):
    """Work shared by the queries of one session: the learning table and the fitted models."""
    slot = (spark.sparkContext.applicationId, folder, name)
    if slot not in _cache:
        _cache[slot] = make()
    return _cache[slot]


def _table(spark, folder):
    def make():
        first, last = trade.shipping_days(spark, folder)
        since = max(first, last - FIT_DAYS + 1)
        return stage(
            L.training_table(trade_features(spark, folder), first_day=since), "learning_table"
        )

    return _once(spark, folder, "table", make)


def _rows(spark, folder, split):
    return _table(spark, folder).filter(F.col("split") == split)


def _tweedie(spark, folder):
    return _once(spark, folder, "tweedie", lambda: L.fit_tweedie(_rows(spark, folder, "train")))


def _boosted(spark, folder):
    return _once(spark, folder, "boosted", lambda: L.fit_boosted(
        _rows(spark, folder, "train"), _rows(spark, folder, "val"),
    ))


def _forest(spark, folder):
    return _once(spark, folder, "forest", lambda: L.fit_forest(_rows(spark, folder, "train")))


def _all(spark, folder):
    return L.fit_all({
        "tweedie": lambda: _tweedie(spark, folder), "boosted": lambda: _boosted(spark, folder),
        "forest": lambda: _forest(spark, folder),
    })


def _latest(spark, folder):
    return A.latest_rows(_rows(spark, folder, "val"))


def tweedie_predictions(spark, folder):
    return L.predict(_tweedie(spark, folder), _rows(spark, folder, "val"))


def boosted_predictions(spark, folder):
    return L.predict(_boosted(spark, folder), _rows(spark, folder, "val"))


def forest_predictions(spark, folder):
    return L.predict(_forest(spark, folder), _rows(spark, folder, "val"))


def model_errors(spark, folder):
    return L.evaluate(_all(spark, folder), _rows(spark, folder, "val"))


def model_comparison(spark, folder):
    return M.metrics_by_model(model_errors(spark, folder), L.MODELS)


def winning_model(spark, folder):
    return M.best_model(model_errors(spark, folder))


def batch_forecast(spark, folder):
    """Forecast, history and metrics for every series and model."""
    fitted = _all(spark, folder)
    latest = L.predict_all(fitted, _latest(spark, folder)).withColumnRenamed("prediction", "predicted_sales")
    history = A.history(trade.dense_sales(spark, folder))
    return I.forecast_rows(latest.drop("sales", "sales_lag_28", "day_num"), history, model_errors(spark, folder))


def model_inventory(spark, folder):
    """A recommendation for every series from the boosted model, on the stock known before its day."""
    latest = _latest(spark, folder)
    predicted = L.predict(_boosted(spark, folder), latest, settings.SERIES_KEY)
    deviations = A.demand_deviation(trade.dense_sales(spark, folder))
    return I.inventory_requests(
        predicted.withColumnRenamed("prediction", "predicted_sales"), deviations,
        _positions(spark, folder, latest.select(*settings.SERIES_KEY, settings.ORDER)),
    )


def model_importances(spark, folder):
    return L.importances(_boosted(spark, folder), 20).unionByName(L.importances(_forest(spark, folder), 20))


def prediction_comparison(spark, folder):
    return L.compare_predictions(L.predict_all(_all(spark, folder), _rows(spark, folder, "val")))


def prediction_sample(spark, folder):
    return L.sample_predictions(L.predict_all(_all(spark, folder), _rows(spark, folder, "val")))


def model_registry(spark, folder):
    """Write model metadata, read it back, list models with one that does not exist."""
    path = new_path(spark, "models")
    errors = model_errors(spark, folder).select("model", "rmse", "mae", "rmsse")
    files.write_model_metadata(
        files.model_metadata(errors, L.tree_features(), {"rows": "train"}), path
    )
    return files.list_models(files.read_model_metadata(spark, path), (*L.MODELS, "absent"))


def tree_attributions(spark, folder):
    """Contribution of every feature to every validation prediction of the boosted trees."""
    return E.long_form(E.explain(_boosted(spark, folder), _rows(spark, folder, "val")))


def linear_attributions(spark, folder):
    return E.long_form(E.explain(_tweedie(spark, folder), _rows(spark, folder, "val")))


def _summary(spark, folder):
    return E.summarize(E.explain(_boosted(spark, folder), _latest(spark, folder)))


def explanation_summary(spark, folder):
    return _summary(spark, folder)


def explanation_sentences(spark, folder):
    return E.interpretation(_summary(spark, folder)).select("store_id", "item_id", "interpretation")


def explanation_waterfall(spark, folder):
    return E.waterfall(_summary(spark, folder))


def attribution_importance(spark, folder):
    """Mean absolute contribution over all validation rows."""
    return E.global_importance(E.explain(_boosted(spark, folder), _rows(spark, folder, "val")))


def explained_questions(spark, folder):
    """A question per series of the whole history, with the explanation of its forecast."""
    series = trade.sales_cells(spark, folder).select("store_id", "item_id").distinct()
    questions = series.withColumn("question", F.concat(F.lit("Why this forecast for "), "item_id", F.lit("?")))
    return E.attach_explanations(questions, _summary(spark, folder))


QUERIES = {
    f.__name__: f
    for f in (
        tweedie_predictions, boosted_predictions, forest_predictions, model_errors,
        model_comparison, winning_model, batch_forecast, model_inventory, model_importances,
        prediction_comparison, prediction_sample, model_registry, tree_attributions,
        linear_attributions, explanation_summary, explanation_sentences, explanation_waterfall,
        attribution_importance, explained_questions,
    )
}
ORACLES: dict[str, str] = {}
