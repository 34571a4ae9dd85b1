"""Additive attribution: how much each feature moved a prediction away from the average one.

Linear models are split exactly by column expressions, on the scale of the link. Trees are split
by path-dependent Shapley values (`panelkit.operators.trees`), whole Arrow batches at a time.
Contributions stay arrays inside the row; nothing is shuffled to rank them.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit import settings
from panelkit.operators import trees
from panelkit.operators.models import Fitted, TreeModel
from panelkit.operators.trees import TreeEnsemble
from panelkit.storage import new_path

KEY = (*settings.SERIES_KEY, settings.ORDER)


def tree_ensemble(fitted: Fitted) -> TreeEnsemble:
    """The nodes of a fitted model; a forest's are read from its saved form."""
    if isinstance(fitted.model, TreeModel):
        return fitted.model.trees
    model = fitted.model.stages[-1]
    spark = SparkSession.getActiveSession()
    path = new_path(spark, "trees")
    model.write().save(path)
    count = model.getNumTrees
    return trees.from_nodes(spark.read.parquet(f"{path}/data"), [1.0 / count] * count)


def _contributions(features: Sequence[str], values: Column, impacts: Column) -> Column:
    names = F.array(*[F.lit(f) for f in features])
    return F.transform(
        F.arrays_zip(names.alias("n"), values.alias("v"), impacts.alias("i")),
        lambda z: F.struct(z["n"].alias("feature"), z["v"].alias("value"), z["i"].alias("impact")),
    )


def explain_trees(fitted: Fitted, rows: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Key, prediction, base value, and a contribution per feature; base + impacts = prediction.

    Boosted trees add up on the scale of the link, the log of the prediction.
    """
    ensemble = replace(tree_ensemble(fitted))
    features, base = list(fitted.features), ensemble.expected
    inputs = rows.select(
        *key, F.array(*[F.col(f).cast("double") for f in features]).alias("values")
    )

    def impacts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = np.array(batch["values"].tolist(), dtype=float).reshape(len(batch), len(features))
            batch["impacts"] = list(ensemble.contributions(values))
            yield batch

    schema = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in inputs.schema.fields
    ) + ", impacts array<double>"
    return _told(
        fitted.name, features, inputs.mapInPandas(impacts, schema), key, base, ensemble.link
    )


def _told(
    name: str, features: Sequence[str], arrays: DataFrame, key: Sequence[str], base: float, link: str
) -> DataFrame:
    return arrays.select(
        *key,
        F.lit(name).alias("model"), F.lit(link).alias("link"),
        (F.lit(base) + F.aggregate("impacts", F.lit(0.0), lambda a, x: a + x)).alias("prediction"),
        F.lit(base).alias("base_value"),
        _contributions(features, F.col("values"), F.col("impacts")).alias("contributions"),
    )


def explain_weights(
    rows: DataFrame,
    weights: Mapping[str, float],
    centers: Mapping[str, float],
    base: float,
    name: str = "weights",
    link: str = "identity",
    key: Sequence[str] = KEY,
) -> DataFrame:
    """The same for any weighted sum: a feature moves it by its weight times its distance from the
    center, and nothing else does."""
    values = [F.col(f).cast("double") for f in weights]
    impacts = [(x - float(centers[f])) * float(w) for x, (f, w) in zip(values, weights.items(), strict=True)]
    arrays = rows.select(*key, F.array(*values).alias("values"), F.array(*impacts).alias("impacts"))
    return _told(name, list(weights), arrays, key, base, link)


def explain_linear(fitted: Fitted, rows: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """The same for the Tweedie regression, on the scale of the link: log of the prediction."""
    scaler, regression = fitted.model.stages[1], fitted.model.stages[2]
    slopes = {
        f: float(b / s if s > 0 else 0.0)
        for f, b, s in zip(fitted.features, regression.coefficients.toArray(), scaler.std.toArray(), strict=True)
    }
    centers = dict(zip(fitted.features, map(float, scaler.mean.toArray()), strict=True))
    return explain_weights(rows, slopes, centers, float(regression.intercept), fitted.name, "log", key)


def explain(fitted: Fitted, rows: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return (explain_linear if fitted.name == "tweedie" else explain_trees)(fitted, rows, key)


def _largest(column: Column, n: int, digits: int | None = 4) -> Column:
    """The n contributions of largest size; equal sizes are settled by name."""
    ordered = F.transform(
        F.array_sort(F.transform(column, lambda c: F.struct(
            (-F.abs(c["impact"])).alias("size"), c["feature"].alias("feature"),
            c["value"].alias("value"), c["impact"].alias("impact"),
        ))),
        lambda s: F.struct(
            s["feature"].alias("feature"),
            (F.bround(s["impact"], digits) if digits is not None else s["impact"]).alias("impact"),
            (F.bround(s["value"], digits) if digits is not None else s["value"]).alias("value"),
        ),
    )
    return F.slice(ordered, 1, n)


def summarize(explained: DataFrame, top: int = 5, listed: int = 20) -> DataFrame:
    """The strongest contributions up, down, and overall."""
    c = F.col("contributions")
    return explained.withColumns({
        "prediction": F.bround("prediction", 4),
        "base_value": F.bround("base_value", 4),
        "top_positive": _largest(F.filter(c, lambda x: x["impact"] > 0), top),
        "top_negative": _largest(F.filter(c, lambda x: x["impact"] < 0), top),
        "largest": _largest(c, listed, None),
    }).drop("contributions")


def long_form(explained: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """One row per input row and feature."""
    return explained.select(*key, "model", F.inline("contributions"))


def waterfall(summary: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Strongest contributions of both signs, from the most negative to the most positive."""
    from panelkit.functions.columns import shorten

    bars = F.transform(
        F.array_sort(F.transform(
            F.concat("top_positive", "top_negative"),
            lambda c: F.struct(c["impact"].alias("impact"), c["feature"].alias("feature")),
        )),
        lambda c: F.struct(
            shorten(c["feature"]).alias("feature"), c["impact"].alias("impact"),
            F.when(c["impact"] > 0, "positive").otherwise("negative").alias("type"),
        ),
    )
    return summary.select(*key, F.posexplode(bars).alias("position", "_bar")).select(
        *key, "position", "_bar.*"
    )


def interpretation(summary: DataFrame, n: int = 3) -> DataFrame:
    """A sentence on every prediction and its main drivers."""
    def listing(column: str, sign: str) -> Column:
        return F.array_join(F.transform(F.slice(column, 1, n), lambda c: F.concat(
            c["feature"], F.lit(f" ({sign}"), F.bround(c["impact"], 4).cast("decimal(28,4)").cast("string"), F.lit(")")
        )), ", ")

    units = F.when(F.col("link") == "log", F.exp("prediction")).otherwise(F.col("prediction"))
    return summary.withColumn("interpretation", F.concat(
        F.bround(units, 2).cast("decimal(28,2)").cast("string"),
        F.lit(" units are predicted. Raised by: "), listing("top_positive", "+"),
        F.lit("; lowered by: "), listing("top_negative", ""), F.lit("."),
    ))


def global_importance(
    explained: DataFrame, sample_rows: int | None = None, seed: int = settings.SEED,
    key: Sequence[str] = KEY,
) -> DataFrame:
    """Mean absolute contribution per feature, ranked; optionally over a seeded sample of rows."""
    if sample_rows is not None:
        explained = explained.orderBy(F.xxhash64(*key, F.lit(seed)), *key).limit(sample_rows)
    means = long_form(explained, key).groupBy("feature").agg(
        F.bround(F.avg(F.abs("impact")), 6).alias("mean_abs_shap")
    )
    from pyspark.sql import Window as W

    # One row per feature: a fixed handful.
    rank = F.row_number().over(W.partitionBy(F.lit(1)).orderBy(F.desc("mean_abs_shap"), "feature"))
    return means.select(rank.alias("rank"), "feature", "mean_abs_shap")


def attach_explanations(
    questions: DataFrame, summary: DataFrame, key: Sequence[str] = settings.SERIES_KEY
) -> DataFrame:
    """Questions about a store and item, with the explanation of its latest forecast."""
    told = interpretation(summary).select(*key, "prediction", "interpretation")
    return questions.join(told, list(key), "left").withColumn(
        "enriched", F.col("interpretation").isNotNull()
    )
