"""Demand models: Tweedie regression and random forest on Spark ML, boosted trees with Tweedie loss.

Spark's boosted trees have no Tweedie loss, so `panelkit.operators.boosting` has its own.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit import settings
from panelkit.operators import boosting, trees
from panelkit.operators import features as X
from panelkit.operators import metrics as M
from panelkit.operators.split import drop_warm_up, fill_missing
from panelkit.storage import stage

LABEL = settings.VALUE
MODELS = ("tweedie", "boosted", "forest")

# Learning parameters.
ROUNDS, PATIENCE, STEP, DEPTH, FRACTION = 500, 50, 0.05, 8, 0.8
VARIANCE_POWER = 1.1


def tree_features(leaky: bool = False) -> list[str]:
    """Every model feature; those that contain the answer only on request."""
    return [c for c in settings.FEATURE_COLUMNS if leaky or c not in settings.LEAKY_FEATURES]


def linear_features(leaky: bool = False) -> list[str]:
    """Without codes, which are no quantities, and without columns that others add up to."""
    dependent = {"day_num", "wm_yr_wk", "year", "day_of_year", "week_of_year", "quarter", "has_any_event",
                 "snap_CA", "snap_TX", "snap_WI", "sell_price", "sales_r56_median", "sales_r56_min"}
    return [c for c in tree_features(leaky) if not c.endswith("_enc") and c not in dependent]


def with_train_averages(
    table: DataFrame, key: Sequence[str] = settings.SERIES_KEY, history: DataFrame | None = None
) -> DataFrame:
    """Replace the group averages by those of the training rows, so validation rows stay unseen.

    `history` has the training rows, where `table` has only some of them.
    """
    seen = table if history is None else history
    series = stage(X.series_table(seen.filter(F.col("split") == "train"), key), "train_totals")
    means = X.group_means(series, X.AVERAGES).select(*key, *X.AVERAGES.values())
    return table.drop(*X.AVERAGES.values()).join(means, list(key), "left")


def training_table(
    features: DataFrame, leaky: bool = False, first_day: int | None = None
) -> DataFrame:
    """Rows to learn from and to validate on: warm-up dropped, gaps filled with 0.

    `first_day` bounds the rows only: features and averages are those of all days. The features of
    the rows are written once: the averages of the training rows are joined to them.
    """
    history = drop_warm_up(features)
    if first_day is None:
        history = complete = stage(history, "complete_features")
    else:
        complete = stage(history.filter(F.col(settings.ORDER) >= first_day), "complete_features")
    fair = complete if leaky else with_train_averages(complete, history=history)
    filled = fill_missing(fair, [c for c in settings.FEATURE_COLUMNS if c in fair.columns])
    return filled.withColumn(LABEL, F.col(LABEL).cast("double"))


@dataclass
class TreeModel:
    """An ensemble with the columns it reads."""

    trees: trees.TreeEnsemble
    features: list[str]

    def transform(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("prediction", trees.predicted(self.trees, self.features))


@dataclass
class Fitted:
    """A fitted model with what it was fitted on."""

    name: str
    model: PipelineModel | TreeModel
    features: list[str]
    info: dict[str, str] = field(default_factory=dict)


def _assembler(features: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="keep")


def fit_tweedie(
    train: DataFrame,
    features: Sequence[str] | None = None,
    variance_power: float = VARIANCE_POWER,
    regularization: float = 0.01,
    max_iterations: int = 25,
) -> Fitted:
    """Tweedie regression with a log link on standardized features."""
    features = list(features or linear_features())
    assembler = _assembler(features, "raw_features")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True).fit(
        assembler.transform(train)
    )
    regression = GeneralizedLinearRegression(
        family="tweedie", variancePower=variance_power, linkPower=0.0, labelCol=LABEL,
        regParam=regularization, maxIter=max_iterations,
    )
    prepared = PipelineModel([assembler, scaler])
    fitted = regression.fit(prepared.transform(train))
    return Fitted(
        "tweedie", PipelineModel([assembler, scaler, fitted]), features,
        {"loss": f"tweedie({variance_power})"},
    )


def fit_boosted(
    train: DataFrame,
    validation: DataFrame | None = None,
    features: Sequence[str] | None = None,
    rounds: int = ROUNDS,
    patience: int = PATIENCE,
    depth: int = DEPTH,
    step: float = STEP,
    seed: int = settings.SEED,
    variance_power: float = VARIANCE_POWER,
    shape_rows: int = boosting.SHAPE_ROWS,
) -> Fitted:
    """Boosted trees with the Tweedie loss and a log link.

    With validation rows the fit stops `patience` rounds after the best validation loss, and the
    ensemble is cut to the rounds up to there. `shape_rows` bounds the labelled rows that splits are
    searched on; leaf values and losses are those of all rows.
    """
    features = list(features or tree_features())
    fitted = boosting.fit(
        train, validation, features, LABEL, rounds, patience, depth, step, FRACTION,
        boosting.Tweedie(variance_power), seed=seed, shape_rows=shape_rows,
    )
    return Fitted(
        "boosted", TreeModel(fitted.trees, features), features,
        {"rounds": str(fitted.rounds), "best_round": str(fitted.best_round),
         "loss": f"tweedie({variance_power})",
         "train_loss": ",".join(map(repr, fitted.train_loss))},
    )


def fit_forest(
    train: DataFrame,
    features: Sequence[str] | None = None,
    trees: int = 50,
    depth: int = DEPTH,
    seed: int = settings.SEED,
) -> Fitted:
    """A random forest."""
    features = list(features or tree_features())
    assembler = _assembler(features)
    forest = RandomForestRegressor(
        labelCol=LABEL, numTrees=trees, maxDepth=depth, subsamplingRate=FRACTION, seed=seed
    ).fit(assembler.transform(train).select("features", LABEL))
    return Fitted("forest", PipelineModel([assembler, forest]), features, {"trees": str(trees)})


def fit_all(recipes: Mapping[str, Callable[[], Fitted]]) -> dict[str, Fitted]:
    """Fit every recipe; one that fails is reported and left out."""
    fitted = {}
    for name, recipe in recipes.items():
        try:
            fitted[name] = recipe()
        except Exception:  # whatever breaks one model must not cost the others
            logging.getLogger(__name__).exception("model %s failed", name)
    return fitted


def predict(
    fitted: Fitted, rows: DataFrame, keep: Sequence[str] = (*settings.SERIES_KEY, settings.ORDER)
) -> DataFrame:
    """Predictions, never negative, next to the kept columns."""
    scored = fitted.model.transform(rows)
    return scored.select(
        *keep, F.lit(fitted.name).alias("model"), F.greatest(F.lit(0.0), "prediction").alias("prediction")
    )


def predict_all(
    fitted: Mapping[str, Fitted],
    rows: DataFrame,
    keep: Sequence[str] = (*settings.SERIES_KEY, settings.ORDER, LABEL, "sales_lag_28"),
) -> DataFrame:
    """One row per model and input row."""
    out = None
    for one in fitted.values():
        part = predict(one, rows, keep)
        out = part if out is None else out.unionByName(part)
    return out


def evaluate(fitted: Mapping[str, Fitted], validation: DataFrame) -> DataFrame:
    """RMSE, MAE and RMSSE per model."""
    return M.forecast_errors(predict_all(fitted, validation))


def importances(fitted: Fitted, top_n: int | None = None) -> DataFrame:
    """(model, rank, feature, importance, relative), largest first; at most one row per feature."""
    from pyspark.sql import SparkSession

    if isinstance(fitted.model, TreeModel):
        vector = fitted.model.trees.importances(len(fitted.features))
    else:
        vector = fitted.model.stages[-1].featureImportances.toArray()
    ranked = sorted(zip(fitted.features, vector, strict=True), key=lambda p: (-p[1], p[0]))
    top = max((v for _, v in ranked), default=0.0) or 1.0
    rows = [
        (fitted.name, i, name, float(v), float(v / top))
        for i, (name, v) in enumerate(ranked[:top_n], 1)
    ]
    return SparkSession.getActiveSession().createDataFrame(
        rows, "model string, rank int, feature string, importance double, relative double"
    )


def sample_predictions(
    predictions: DataFrame,
    n: int = 10,
    seed: int = settings.SEED,
    key: Sequence[str] = (*settings.SERIES_KEY, settings.ORDER),
    models: Sequence[str] = MODELS,
) -> DataFrame:
    """n rows drawn by a seeded hash: the actual value, and prediction and error of every model."""
    wide = compare_predictions(predictions, key, models)
    drawn = wide.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), *key)), *key).limit(n)
    return drawn.withColumns({f"{m}_error": F.abs(F.col(m) - F.col(LABEL)) for m in models})


def compare_predictions(
    predictions: DataFrame,
    key: Sequence[str] = (*settings.SERIES_KEY, settings.ORDER),
    models: Sequence[str] = MODELS,
) -> DataFrame:
    """One row per input row, one column per model."""
    return predictions.groupBy(*key, LABEL).pivot("model", list(models)).agg(F.first("prediction"))


def save(fitted: Fitted, path: str) -> None:
    if isinstance(fitted.model, TreeModel):
        trees.save(fitted.model.trees, path)
    else:
        fitted.model.write().overwrite().save(path)


def load(name: str, path: str, features: Sequence[str]) -> Fitted:
    if name == "boosted":
        return Fitted(name, TreeModel(trees.load(path), list(features)), list(features))
    return Fitted(name, PipelineModel.load(path), list(features))
