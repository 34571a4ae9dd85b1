"""Questions to intents, and intents to answers, for whole tables of questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit import settings
from panelkit.functions.columns import contains_any, first_match, fixed_text
from panelkit.functions.text import GENERAL, INTENTS
from panelkit.operators.retrieval import expand_question


def intent(question: Column) -> Column:
    """The first intent with a phrase in the question."""
    return first_match(F.lower(question), INTENTS, GENERAL)


def top_forecasts(
    forecasts: DataFrame, n: int = 5, predicted: str = "predicted_sales"
) -> DataFrame:
    """The n series with the highest positive prediction."""
    return (
        forecasts.filter(F.col(predicted) > 0)
        .orderBy(F.desc(predicted), "store_id", "item_id").limit(n)
    )


def with_catalog(forecasts: DataFrame, profile: DataFrame) -> DataFrame:
    """The historical average next to each forecast."""
    return forecasts.join(
        profile.select("store_id", "item_id", "avg_sales"), ["store_id", "item_id"], "left"
    )


def horizon_total(top: DataFrame, days: int = settings.HORIZON_DAYS, predicted: str = "predicted_sales") -> DataFrame:
    return top.agg(F.bround(F.sum(F.bround(predicted, 2) * days), 2).alias("total_demand"))


def _lines(df: DataFrame, line: Column, order: list[Column], separator: str = "\n") -> DataFrame:
    """A bounded ranking as one text, in order."""
    return df.agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct(*order, line.alias("_line")))), lambda s: s["_line"]
    ), separator).alias("_text"))


def _product_line(store: Column, item: Column, predicted: Column, average: Column) -> Column:
    """A product with its prediction and its historical average, as far as they are known."""
    return F.concat(item, F.lit(" @ "), store, F.lit(": "), F.concat_ws(
        ", ",
        F.concat(F.lit("predicted "), fixed_text(predicted, 1), F.lit(" units/day")),
        F.concat(F.lit("historical average "), fixed_text(average, 1)),
    ))


def restock_answer(top: DataFrame, days: int = settings.HORIZON_DAYS) -> DataFrame:
    """`top`: at most a handful of forecasts with their historical average."""
    line = _product_line(*map(F.col, ("store_id", "item_id", "predicted_sales", "avg_sales")))
    body = _lines(top, line, [(-F.col("predicted_sales")).alias("_a"), F.col("store_id"), F.col("item_id")])
    total = top.agg(F.sum(F.bround("predicted_sales", 2) * days)).scalar()
    return body.select(F.when(
        total.isNotNull(),
        F.concat(F.lit("Highest predicted demand:\n"), F.col("_text"),
                 F.lit(f"\nDemand of these over {days} days: "), fixed_text(total, 0), F.lit(" units")),
    ).otherwise("All products have low predicted demand; nothing needs restocking now.").alias("answer"))


def slow_answer(slow: DataFrame, per_store: int = 5) -> DataFrame:
    """The slowest products of every store, at most `per_store` of each."""
    status = F.when(F.col("avg_sales") < 0.2, "critical, consider delisting").when(
        F.col("avg_sales") < 0.5, "low, promote or reprice"
    ).otherwise("below average, monitor")
    rank = F.row_number().over(W.partitionBy("store_id").orderBy("avg_sales", "item_id"))
    listed = slow.withColumn("_rank", rank).filter(F.col("_rank") <= per_store)
    line = F.concat(
        F.col("store_id"), F.lit(" / "), F.col("item_id"), F.lit(": "),
        fixed_text(F.col("avg_sales"), 2), F.lit("/day ("), status, F.lit(")"),
    )
    body = _lines(listed, line, [F.col("store_id"), F.col("_rank")])
    return body.select(F.when(
        F.col("_text") != "", F.concat(F.lit("Slowest tenth by average daily sales:\n"), F.col("_text"))
    ).otherwise("No underperforming products.").alias("answer"))


def store_answer(stores: DataFrame, categories: DataFrame) -> DataFrame:
    """All stores by total sales, then the category breakdown."""
    line = F.concat_ws(
        " | ", "store_id", F.col("total_sales").cast("string"), fixed_text(F.col("avg_daily"), 2),
        F.col("best_day").cast("string"),
    )
    body = _lines(stores, line, [(-F.col("total_sales")).alias("_a"), F.col("store_id")])
    kind = F.concat(F.col("cat_id"), F.lit(": "), F.col("total_sales").cast("string"))
    second = _lines(categories, kind, [(-F.col("total_sales")).alias("_a"), F.col("cat_id")]).scalar()
    return body.select(F.concat(
        F.lit("store | total | average | best day\n"), F.col("_text"), F.lit("\n"), second
    ).alias("answer"))


# What moves demand: (words in the question, words in a document, sentence).
DRIVERS = (
    ((), ("SNAP",), "Benefit days: eligible food sells more when benefits are paid out."),
    (("weekend",), ("weekend",), "Weekends: shopping shifts to Saturday and Sunday."),
    (("holiday",), ("event",), "Events: holidays cause spikes that event flags capture."),
    (("price",), ("price",), "Price: reductions and promotions lift demand."),
    (("seasonal",), ("lag",), "Season: sales follow weekly and monthly cycles seen in the lags."),
)
DEFAULT_DRIVERS = (
    "History: recent sales are the main driver, through lags and rolling statistics.",
    "Context: store and category averages set the base level.",
)

# What a measure means: (word in a document, sentence); the first word found speaks.
MEASURES = (
    ("RMSE", "RMSE: typical size of a forecast error, large errors weighing more; lower is better."),
    ("RMSSE", "RMSSE: error relative to a naive forecast; below 1 beats it."),
    ("Safety stock", "Safety stock: buffer against demand variability."),
    ("Reorder Point", "Reorder point: demand over the lead time plus safety stock."),
    ("SHAP", "SHAP: contribution of each feature to a prediction."),
    ("Tweedie", "Tweedie loss: made for sales with many zero days."),
)


def _sentences_about(question: Column, content: Column) -> Column:
    """Driver sentences a document calls for. Abbreviations are matched as written."""
    return F.filter(F.array(*[
        F.when(
            contains_any(F.lower(question), asked)
            | (contains_any(content, said) if any(w.isupper() for w in said)
               else contains_any(F.lower(content), said)),
            F.lit(sentence),
        )
        for asked, said, sentence in DRIVERS
    ]), lambda s: s.isNotNull())


def _facts(doc: Column) -> Column:
    """What a document says of a product: prediction, average, store, item; null where it does not."""
    said = doc["metadata"]
    return F.struct(
        said["predicted_sales"].cast("double").alias("predicted"), said["avg_sales"].cast("double").alias("average"),
        said["store_id"].alias("store"), said["item_id"].alias("item"),
    )


def _line_of(fact: Column) -> Column:
    return _product_line(fact["store"], fact["item"], fact["predicted"], fact["average"])


def _example(docs: Column) -> Column:
    """The forecast document found first, as a line; null without one."""
    fact = _facts(F.get(F.filter(docs, lambda d: d["type"] == "forecast"), F.lit(0)))
    return F.concat(F.lit("For example, "), _line_of(fact))


def _best_found(docs: Column, n: int = 5, days: int = settings.HORIZON_DAYS) -> Column:
    """The best products among the documents found, with their demand; null where none is known.

    Products with a positive forecast in descending order; where the question found no forecast,
    those of catalog and top performers by their average. Equal values go by store and item.
    """
    def ranked(kinds: tuple[str, ...], value: str) -> Column:
        facts = F.transform(F.filter(docs, lambda d: d["type"].isin(*kinds)), _facts)
        known = F.filter(facts, lambda f: (f[value] > 0) & f["item"].isNotNull() & f["store"].isNotNull())
        keyed = F.transform(known, lambda f: F.struct((-f[value]).alias("down"), f["store"], f["item"], f.alias("fact")))
        return F.transform(F.slice(F.sort_array(F.array_distinct(keyed)), 1, n), lambda s: s["fact"])

    forecast, others = ranked(("forecast",), "predicted"), ranked(("catalog", "top_performer"), "average")
    total = F.aggregate(forecast, F.lit(0.0), lambda a, f: a + F.bround(f["predicted"], 2) * days)
    return F.when(F.size(forecast) > 0, F.concat(
        F.lit("Highest predicted demand:\n"), F.array_join(F.transform(forecast, _line_of), "\n"),
        F.lit(f"\nDemand of these over {days} days: "), fixed_text(total, 0), F.lit(" units"),
    )).when(F.size(others) > 0, F.concat(
        F.lit("Best average sales:\n"), F.array_join(F.transform(others, _line_of), "\n"),
    ))


def answer_questions(
    questions: DataFrame,
    retrieved: DataFrame,
    fixed_answers: DataFrame,
    question_key: str = "question_id",
) -> DataFrame:
    """An answer and its sources for every question.

    `retrieved` holds at most top-k documents per question (rank, score, type, content, and the
    metadata where known), which bounds every list. Explanations and best products name products of
    the question's own documents. `fixed_answers` has one row per intent whose answer does not depend
    on the question: (intent, answer); its size decides how the engine joins it.
    """
    if "metadata" not in retrieved.columns:
        retrieved = retrieved.withColumn("metadata", F.lit(None).cast("map<string,string>"))
    routed = questions.withColumn("intent", intent(F.col("question")))
    docs = retrieved.groupBy(question_key).agg(
        F.array_sort(
            F.collect_list(F.struct("rank", "score", "type", "content", "metadata")),
            lambda a, b: F.when(a["rank"] < b["rank"], -1).when(a["rank"] > b["rank"], 1).otherwise(0),
        ).alias("_docs")
    )
    rows = routed.join(docs, question_key, "left").withColumn(
        "_docs", F.coalesce("_docs", F.expr("cast(array() as array<struct<rank:int,score:double,type:string,content:string,metadata:map<string,string>>>)"))
    ).withColumn("_known", F.filter("_docs", lambda d: d["type"] == "business_knowledge"))
    found = F.flatten(F.transform(
        F.slice("_known", 1, 5), lambda d: _sentences_about(F.col("question"), d["content"])
    ))
    drivers = F.when(F.size(found) > 0, found).otherwise(F.array(*map(F.lit, DEFAULT_DRIVERS)))
    measures = F.filter(F.transform(F.slice("_known", 1, 6), lambda d: F.coalesce(
        *[F.when(F.contains(d["content"], F.lit(w)), F.lit(s)) for w, s in MEASURES],
        F.lit(None).cast("string"),
    )), lambda s: s.isNotNull())
    general = F.when(F.size("_docs") > 0, F.array_join(F.transform(
        F.slice("_docs", 1, 5),
        lambda d: F.concat(
            d["rank"].cast("string"), F.lit(". (relevance "), fixed_text(d["score"] * 100, 1),
            F.lit("%) "), d["content"],
        ),
    ), "\n")).otherwise("Nothing relevant was found.")
    own = (
        F.when(F.col("intent") == "explanation", F.concat_ws("\n", F.array_join(drivers, "\n"), _example(F.col("_docs"))))
        .when(F.col("intent") == "top", F.coalesce(_best_found(F.col("_docs")), general))
        .when((F.col("intent") == "kpi") & (F.size(measures) > 0), F.array_join(measures, "\n"))
        .when(
            (F.col("intent") == "inventory_knowledge") & (F.size("_known") > 0),
            F.get(F.col("_known"), F.lit(0))["content"],
        )
        .otherwise(general)
    )
    fixed = fixed_answers.withColumnRenamed("answer", "_fixed")
    return rows.join(fixed, "intent", "left").select(
        question_key, "question", "intent",
        F.coalesce("_fixed", own).alias("answer"),
        F.size("_docs").alias("retrieval_count"),
        F.transform(F.slice("_docs", 1, 5), lambda d: F.struct(
            F.substring(d["content"], 1, 200).alias("content"),
            F.bround(d["score"], 4).alias("score"), d["type"].alias("type"),
        )).alias("sources"),
    )


def expand_flagged(questions: DataFrame, key: Sequence[str] = settings.SERIES_KEY) -> DataFrame:
    """Questions that ask for an explanation (`explain`) name their store and item before retrieval.

    Others, and those with a null flag, stay as they are; an unknown store or item is left out.
    """
    store, item = key
    expanded = expand_question(F.col("question"), F.col(store), F.col(item))
    return questions.withColumn("question", F.when(F.col("explain"), expanded).otherwise(F.col("question")))


def explain_answers(
    answers: DataFrame,
    questions: DataFrame,
    told: DataFrame,
    question_key: str = "question_id",
    key: Sequence[str] = settings.SERIES_KEY,
) -> DataFrame:
    """Answers with the explanation of the forecast they are about, where the question asks for it.

    `questions` has one row per question with store, item and the flag `explain`; `told` one row per
    series with an `interpretation`. `enriched` tells whether one was attached: not where the flag is
    off or null, nor where the series is unknown or has no explanation.
    """
    flagged = questions.filter("explain").select(question_key, *key)
    said = flagged.join(told.select(*key, F.col("interpretation").alias("explanation")), list(key)).drop(*key)
    enriched = F.col("explanation").isNotNull()
    return answers.join(said, question_key, "left").withColumns({
        "answer": F.concat_ws("\n\n", "answer", "explanation"), "enriched": enriched,
    })


def source_snippets(retrieved: DataFrame, question_key: str = "question_id", n: int = 5, chars: int = 200) -> DataFrame:
    """The start of the first documents of every question."""
    return retrieved.filter(F.col("rank") <= n).select(
        question_key, "rank", F.substring("content", 1, chars).alias("content"), "score", "type"
    )


def context_blocks(retrieved: DataFrame, question_key: str = "question_id", n: int = 8) -> DataFrame:
    """The first documents of every question as one numbered block of text."""
    line = F.concat(
        F.lit("["), F.col("rank").cast("string"), F.lit("] ("), F.col("type"), F.lit(") "), F.col("content")
    )
    return retrieved.filter(F.col("rank") <= n).groupBy(question_key).agg(
        F.array_join(F.transform(
            F.sort_array(F.collect_list(F.struct("rank", line.alias("line")))), lambda s: s["line"]
        ), "\n").alias("context")
    )


# Standing advice at the end of every report.
ADVICE = (
    "Restock the five products with the highest forecast first",
    "Test price promotions on products selling 0.2 to 0.5 a day",
    "Consider delisting products selling less than 0.2 a day",
    "Watch food categories on benefit days",
)


def daily_report(
    forecasts: DataFrame, slow: DataFrame, stores: DataFrame, categories: DataFrame,
    metrics: DataFrame | None = None,
) -> DataFrame:
    """(section, rank, key, payload): top forecasts, risks, stores, categories, models, advice."""
    def section(df, name, n, order, key, *payload):
        top = df.orderBy(*order).limit(n)
        # At most n rows are ranked here.
        rank = F.row_number().over(W.partitionBy(F.lit(name)).orderBy(*order))
        return top.select(
            F.lit(name).alias("section"), rank.alias("rank"), F.concat_ws("/", *key).alias("key"),
            F.to_json(F.struct(*payload)).alias("payload"),
        )

    two = ["store_id", "item_id"]
    parts = [
        section(forecasts, "top_products", 5, [F.desc("predicted_sales"), *two], two,
                fixed_text(F.col("predicted_sales"), 2).alias("predicted_daily"), "model"),
        section(slow, "risk_products", 10, ["avg_sales", *two], two,
                fixed_text(F.col("avg_sales"), 2).alias("avg_daily_sales")),
        section(stores, "store_performance", 10, [F.desc("total_sales"), "store_id"], ["store_id"],
                "total_sales", fixed_text(F.col("avg_daily"), 2).alias("avg_daily"), "best_day"),
        section(categories, "category_breakdown", 5, [F.desc("total_sales"), "cat_id"], ["cat_id"],
                "n_products", "total_sales", fixed_text(F.col("avg_daily"), 2).alias("avg_daily")),
    ]
    if metrics is not None:
        parts.append(section(metrics, "model_performance", 10, ["rmse", "model"], ["model"],
                             *[fixed_text(F.col(c), 4).alias(c) for c in ("rmse", "mae", "rmsse")]))
    advice = forecasts.sparkSession.createDataFrame(
        [("recommendations", i + 1, f"advice_{i + 1}", None) for i in range(len(ADVICE))],
        "section string, rank int, key string, payload string",
    ).withColumn("payload", F.to_json(F.struct(
        F.get(F.array(*map(F.lit, ADVICE)), F.col("rank") - 1).alias("text")
    )))
    out = parts[0]
    for part in [*parts[1:], advice]:
        out = out.unionByName(part)
    return out
