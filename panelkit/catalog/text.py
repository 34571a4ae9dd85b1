"""Queries: term weights, retrieval, intents, documents, answers, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.catalog import sql
from panelkit.catalog.analytics import _AVERAGES, _PREDICTIONS, _errors, _naive_predictions
from panelkit.functions.columns import numbers_in
from panelkit.functions.text import GENERAL, INTENTS, STOP_WORDS
from panelkit.operators import analytics as A
from panelkit.operators import answers as Q
from panelkit.operators import documents as D
from panelkit.operators import metrics as M
from panelkit.operators import retrieval as R
from panelkit.sources import trade
from panelkit.sources.index import open_index, write_index
from panelkit.storage import new_path, stage


def _texts(spark, folder):
    return trade.table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("content"), F.col("lang").alias("type")
    )


def _asked(spark, folder):
    return trade.table(spark, folder, "benchmark").select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question")
    )


def document_terms(spark, folder):
    return R.term_counts(_texts(spark, folder), "id")


def vocabulary(spark, folder):
    terms, _ = R.fit(_texts(spark, folder), max_terms=R.MAX_TERMS)
    return terms.select("term", F.bround("idf", 8).alias("idf"))


def term_weights(spark, folder):
    _, weights = R.fit(_texts(spark, folder))
    return weights.select("id", "term", F.bround("weight", 8).alias("weight"))


def _best(spark, folder, top_k=5, doc_type=None):
    return R.retrieve(_asked(spark, folder), _texts(spark, folder), top_k, doc_type)


def similar_documents(spark, folder):
    """The five most similar documents of every benchmark text."""
    return _best(spark, folder).select("question_id", "rank", "id", F.bround("score", 6).alias("score"))


def similar_documents_of_type(spark, folder):
    """The same among documents of one kind only."""
    return _best(spark, folder, 8, "en").select(
        "question_id", "rank", "id", F.bround("score", 6).alias("score")
    )


def _retrieved(spark, folder, top_k):
    # Few rows, written: their bytes are known, and the texts need no exchange.
    return stage(_best(spark, folder, top_k), "retrieved").join(_texts(spark, folder), "id")


def source_snippets(spark, folder):
    snippets = Q.source_snippets(_retrieved(spark, folder, 8))
    return snippets.withColumn("score", F.bround("score", 6))


def context_blocks(spark, folder):
    return Q.context_blocks(_retrieved(spark, folder, 8))


def question_intents(spark, folder):
    turns = trade.table(spark, folder, "conversations")
    return turns.select("conv_id", "turn", Q.intent(F.col("text")).alias("intent"))


def document_intents(spark, folder):
    """Intents of whole documents, counted by language."""
    texts = trade.table(spark, folder, "documents")
    return texts.groupBy("lang", Q.intent(F.col("text")).alias("intent")).agg(
        F.count("*").alias("n_documents")
    )


def expanded_questions(spark, folder):
    """Parts' names as questions about a store, an item, both or neither."""
    parts = trade.table(spark, folder, "part")
    store = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("S"), F.col("p_size")))
    item = F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand"))
    return parts.select("p_partkey", R.expand_question(F.col("p_name"), store, item).alias("question"))


def text_numbers(spark, folder):
    """Every number in the documents, by position."""
    texts = trade.table(spark, folder, "documents")
    return texts.select("doc_id", F.posexplode(numbers_in(F.col("text"))).alias("position", "number"))


def _panel(spark, folder):
    """The panel, written once for the many reports on it."""
    return stage(trade.panel(spark, folder), "panel")


def _forecasts(spark, folder, panel):
    """The 28-day mean as the forecast of every series' last day."""
    predictions = _naive_predictions(spark, folder, panel).filter(F.col("model") == "mean_28")
    latest = A.latest_rows(predictions)
    metrics = M.forecast_errors(predictions)
    keys = panel.select("store_id", "item_id", "cat_id", "state_id").distinct()
    return latest.join(metrics.select("model", "rmse"), "model").join(
        keys, ["store_id", "item_id"]
    ).withColumn("predicted_sales", F.greatest(F.lit(0.0), F.col("prediction")))


def _retail_documents(spark, folder, panel):
    averages = A.series_average(panel)
    profile = A.catalog_profile(panel)
    return D.union_documents(
        D.catalog_documents(profile),
        D.forecast_documents(Q.with_catalog(_forecasts(spark, folder, panel), profile)),
        D.knowledge_documents(spark),
        D.store_documents(A.store_pattern(panel)),
        D.category_documents(A.category_pattern(panel)),
        D.underperformer_documents(A.underperformers(averages)),
        D.top_performer_documents(A.top_performers(averages)),
    )


def retail_documents(spark, folder):
    """All seven kinds of documents of the panel."""
    return _retail_documents(spark, folder, _panel(spark, folder)).select("id", "content", "type")


def document_store(spark, folder):
    """Write a search index, open it from its folder, search it there."""
    path = new_path(spark, "documents")
    texts = _texts(spark, folder)
    write_index(texts, *R.fit(texts, blocks=True), path)
    stored = open_index(spark, path)
    found = R.retrieve(_asked(spark, folder), stored.documents, 3, index=stored[1:])
    return found.select("question_id", "rank", "id", F.bround("score", 6).alias("score"))


def top_forecasts(spark, folder):
    """The five highest forecasts, next to the historical average."""
    panel = _panel(spark, folder)
    top = Q.with_catalog(Q.top_forecasts(_forecasts(spark, folder, panel)), A.catalog_profile(panel))
    return top.select(
        "store_id", "item_id", F.bround("predicted_sales", 8).alias("predicted_sales"),
        F.bround("avg_sales", 8).alias("avg_sales"),
    )


def horizon_demand(spark, folder):
    return Q.horizon_total(Q.top_forecasts(_forecasts(spark, folder, _panel(spark, folder))))


def daily_report(spark, folder):
    panel = _panel(spark, folder)
    averages = A.series_average(panel)
    return Q.daily_report(
        _forecasts(spark, folder, panel), A.underperformers(averages), A.store_pattern(panel),
        A.category_pattern(panel), M.forecast_errors(_naive_predictions(spark, folder, panel)),
    )


def _questions(spark, folder):
    """Questions about every store and item of the panel."""
    cells = trade.sales_cells(spark, folder)
    stores = cells.select(F.lit("store").alias("about"), F.col("store_id").alias("name")).distinct()
    items = cells.select(F.lit("item").alias("about"), F.col("item_id").alias("name")).distinct()
    # Question forms, one of each per store or item.
    forms = F.array(*[F.concat(F.lit(a), F.col("name"), F.lit(b)) for a, b in (
        ("Which products need restocking at ", "?"), ("Show underperforming products: ", ""),
        ("Why would sales of ", " increase on SNAP days or with the price?"),
        ("What RMSE and SHAP measure holds for ", "?"), ("Compare ", " with the other stores"),
        ("How long is the lead time of ", "?"), ("trending: ", ""), ("Tell me about ", " sales"),
    )])
    return stores.unionAll(items).select("about", "name", F.posexplode(forms).alias("form", "question")).select(
        F.concat_ws("_", "about", "name", F.col("form").cast("string")).alias("question_id"), "question"
    )


def answered(spark, folder, questions):
    """An answer with its sources for every question, from the documents of the panel."""
    panel = _panel(spark, folder)
    documents = stage(_retail_documents(spark, folder, panel), "retail_documents")
    retrieved = R.retrieve(questions, documents, 8).join(documents, "id")
    averages = A.series_average(panel)
    top = Q.with_catalog(Q.top_forecasts(_forecasts(spark, folder, panel)), A.catalog_profile(panel))
    restock = Q.restock_answer(top)
    fixed = D.union_documents(
        restock.withColumn("intent", F.lit("restock")),
        Q.slow_answer(A.underperformers(averages)).withColumn("intent", F.lit("underperforming")),
        Q.store_answer(A.store_pattern(panel), A.category_pattern(panel)).withColumn(
            "intent", F.lit("store_comparison")),
    )
    return Q.answer_questions(questions, retrieved, fixed)


def question_answers(spark, folder):
    return answered(spark, folder, stage(_questions(spark, folder), "questions"))


QUERIES = {
    f.__name__: f
    for f in (
        document_terms, vocabulary, term_weights, similar_documents, similar_documents_of_type,
        source_snippets, context_blocks, question_intents, document_intents, expanded_questions,
        text_numbers, retail_documents, document_store, top_forecasts, horizon_demand,
        daily_report, question_answers,
    )
}

# ------------------------------------------------------------------------------------ SQL

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)


def _counted(name: str, table: str, key: str) -> str:
    return f"""
{name}_words AS (
  SELECT {key} AS id, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
                                  lambda w: w NOT IN ({_STOP})) AS w
  FROM {table}
),
{name}_terms AS (
  SELECT id, term, count(*) AS tf FROM (
    SELECT id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term
    FROM {name}_words)
  GROUP BY ALL
)"""


_INDEX = f"""
{_counted('doc', 'documents', 'doc_id')},
vocabulary AS (
  SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf
  FROM doc_terms GROUP BY term
),
raw AS (SELECT id, term, (1 + ln(tf)) * idf AS x FROM doc_terms JOIN vocabulary USING (term)),
weights AS (SELECT id, term, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS weight FROM raw)"""
_SEARCH = f"""
{_INDEX},
{_counted('ask', 'benchmark', 'item_id')},
ask_raw AS (SELECT id AS question_id, term, (1 + ln(tf)) * idf AS x FROM ask_terms JOIN vocabulary USING (term)),
ask_weights AS (
  SELECT question_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY question_id)) AS asked FROM ask_raw
),
scored AS (
  SELECT question_id, id, sum(weight * asked) AS score FROM weights JOIN ask_weights USING (term) GROUP BY 1, 2
)"""


def _found(k: int, where: str = "") -> str:
    return f"""
found AS (
  SELECT question_id, id, score, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY round_even(score, 9) DESC, id) AS rank
    FROM scored WHERE score > 0.01 {where}) WHERE rank <= {k}
)"""


_RANKS = "SELECT question_id, rank, id, round_even(score, 6) AS score FROM found"


def _intent(x: str) -> str:
    cases = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({x}), '{w}')" for w in phrases) + f" THEN '{name}'"
        for name, phrases in INTENTS
    )
    return f"CASE {cases} ELSE '{GENERAL}' END"


def _fixed(x: str, digits: int) -> str:
    return f"CAST(CAST(round_even({x}, {digits}) AS DECIMAL(28, {digits})) AS VARCHAR)"


_REPORT = f"""
{_AVERAGES},{_PREDICTIONS},{_errors('model')},
cut AS (SELECT quantile_cont(avg_sales, 0.1) AS lo, quantile_cont(avg_sales, 0.9) AS hi FROM averages),
forecasts AS (
  SELECT p.store_id, p.item_id, s.cat_id, s.state_id, p.model, m.rmse, greatest(0, prediction) AS predicted
  FROM predictions p JOIN metrics m USING (model) JOIN series s USING (store_id, item_id)
  WHERE model = 'mean_28' AND day_num = (SELECT max(day_num) FROM days)
),
profile AS (
  SELECT store_id, item_id, dept_id, cat_id, state_id, avg(sales) AS avg_sales, sum(sales) AS total_sales,
         max(sales) AS max_sales, avg(sell_price) AS avg_price,
         avg(CASE WHEN sales = 0 THEN 1 ELSE 0 END) * 100 AS zero_pct, count(*) AS n
  FROM panel GROUP BY ALL
),
stores AS (
  SELECT store_id, CAST(sum(sales) AS BIGINT) AS total_sales, avg(sales) AS avg_daily, max(sales) AS best_day
  FROM panel GROUP BY 1
),
categories AS (
  SELECT cat_id, count(DISTINCT item_id) AS n_products, CAST(sum(sales) AS BIGINT) AS total_sales,
         avg(sales) AS avg_daily, avg(sell_price) AS avg_price
  FROM panel GROUP BY 1
)"""
_KNOWLEDGE = " UNION ALL ".join(
    f"SELECT '{i}', '{t}', 'business_knowledge'" for i, _, t in D.KNOWLEDGE
)
_ADVICE_SQL = " UNION ALL ".join(
    f"""SELECT 'recommendations', {n}, 'advice_{n}', '{{"text":"{t}"}}'""" for n, t in enumerate(Q.ADVICE, 1)
)


def _json(**fields: str) -> str:
    return "'{' || " + " || ',' || ".join(f"'\"{k}\":' || {v}" for k, v in fields.items()) + " || '}'"


def _quoted(x: str) -> str:
    return f"'\"' || {x} || '\"'"


def _section(name: str, table: str, n: int, order: str, key: str, payload: str) -> str:
    return (
        f"SELECT '{name}' AS section, CAST(rank AS INTEGER) AS rank, {key} AS key, {payload} AS payload FROM ("
        f"SELECT *, row_number() OVER (ORDER BY {order}) AS rank FROM {table}) WHERE rank <= {n}"
    )


ORACLES = {
    "document_terms": f"WITH {_counted('doc', 'documents', 'doc_id')} SELECT id, term, tf FROM doc_terms",
    "vocabulary": f"""
WITH {_INDEX} SELECT term, round_even(idf, 8) AS idf FROM vocabulary WHERE term IN (
  SELECT term FROM doc_terms GROUP BY term ORDER BY sum(tf) DESC, term LIMIT {R.MAX_TERMS})""",
    "term_weights": f"WITH {_INDEX} SELECT id, term, round_even(weight, 8) AS weight FROM weights",
    "similar_documents": f"WITH {_SEARCH},{_found(5)} {_RANKS}",
    "similar_documents_of_type":
        f"WITH {_SEARCH},{_found(8, 'AND id IN (SELECT doc_id FROM documents WHERE lang = ' + chr(39) + 'en' + chr(39) + ')')} {_RANKS}",
    "source_snippets": f"WITH {_SEARCH},{_found(5)}" + """
SELECT question_id, rank, substr(text, 1, 200) AS content, round_even(score, 6) AS score, lang AS type
FROM found JOIN documents ON id = doc_id""",
    "context_blocks": f"WITH {_SEARCH},{_found(8)}" + r"""
SELECT question_id, string_agg('[' || CAST(rank AS VARCHAR) || '] (' || lang || ') ' || text, chr(10) ORDER BY rank) AS context
FROM found JOIN documents ON id = doc_id GROUP BY 1""",
    "question_intents": f"SELECT conv_id, turn, {_intent('text')} AS intent FROM conversations",
    "document_intents": f"SELECT lang, {_intent('text')} AS intent, count(*) AS n_documents FROM documents GROUP BY ALL",
    "expanded_questions": """
SELECT p_partkey, p_name || CASE WHEN p_partkey % 2 = 0 THEN ' store S' || CAST(p_size AS VARCHAR) ELSE '' END
       || CASE WHEN p_partkey % 3 = 0 THEN ' product ' || p_brand ELSE '' END AS question
FROM part""",
    "text_numbers": r"""
SELECT doc_id, CAST(unnest(range(len(n))) AS INTEGER) AS position, CAST(unnest(n) AS DOUBLE) AS number
FROM (SELECT doc_id, regexp_extract_all(text, '\d+\.?\d*') AS n FROM documents)""",
    "retail_documents": sql.panel(f"""
SELECT 'catalog_' || store_id || '_' || item_id AS id,
  'Item ' || item_id || ' of ' || dept_id || ' / ' || cat_id || ', sold at ' || store_id || ', ' || state_id
  || ': ' || {_fixed('avg_sales', 2)} || ' units a day on average, ' || CAST(max_sales AS VARCHAR)
  || ' on its best day and ' || CAST(total_sales AS VARCHAR) || ' altogether over ' || CAST(n AS VARCHAR)
  || ' days, of which ' || {_fixed('zero_pct', 1)} || '% were without a sale. It costs $'
  || {_fixed('avg_price', 2)} || ' on average.' AS content, 'catalog' AS type FROM profile
UNION ALL SELECT 'forecast_' || store_id || '_' || item_id,
  model || ' expects ' || item_id || ' (' || cat_id || ') to sell ' || {_fixed('predicted', 2)}
  || ' units a day at ' || store_id || ', ' || state_id || '. This forecast has a validation RMSE of '
  || {_fixed('rmse', 4)} || '.', 'forecast' FROM forecasts
UNION ALL {_KNOWLEDGE}
UNION ALL SELECT 'store_pattern_' || store_id, store_id || ' is a store that sold ' || CAST(total_sales AS VARCHAR)
  || ' units: ' || {_fixed('avg_daily', 2)} || ' per product and day, ' || CAST(best_day AS VARCHAR)
  || ' of one product on the best day.',
  'store_pattern' FROM stores
UNION ALL SELECT 'cat_pattern_' || cat_id, cat_id || ' is a category of ' || CAST(n_products AS VARCHAR)
  || ' items that sold ' || CAST(total_sales AS VARCHAR) || ' units, ' || {_fixed('avg_daily', 2)}
  || ' per product and day, at a mean price of $' || {_fixed('avg_price', 2)} || '.', 'category_pattern' FROM categories
UNION ALL SELECT 'underperformer_' || store_id || '_' || item_id, item_id || ' underperforms at '
  || store_id || ': with ' || {_fixed('avg_sales', 2)}
  || ' units a day it is in the slowest tenth, where a lower price, a promotion or its place is in question.', 'underperformer'
  FROM averages WHERE avg_sales <= (SELECT lo FROM cut)
UNION ALL SELECT 'top_performer_' || store_id || '_' || item_id, item_id || ' is a top product at '
  || store_id || ': with ' || {_fixed('avg_sales', 2)}
  || ' units a day it is in the fastest tenth and must not run out.', 'top_performer'
  FROM averages WHERE avg_sales >= (SELECT hi FROM cut)""", ctes=_REPORT),
    "document_store": f"WITH {_SEARCH},{_found(3)} {_RANKS}",
    "top_forecasts": sql.panel("""
SELECT store_id, item_id, round_even(predicted, 8) AS predicted_sales, round_even(avg_sales, 8) AS avg_sales
FROM forecasts JOIN averages USING (store_id, item_id) WHERE predicted > 0
ORDER BY predicted DESC, store_id, item_id LIMIT 5""", ctes=_REPORT),
    "horizon_demand": sql.panel("""
SELECT round_even(sum(round_even(predicted, 2) * 28), 2) AS total_demand FROM (
  SELECT * FROM forecasts WHERE predicted > 0 ORDER BY predicted DESC, store_id, item_id LIMIT 5)""", ctes=_REPORT),
    "daily_report": sql.panel(" UNION ALL ".join([
        _section("top_products", "forecasts", 5, "predicted DESC, store_id, item_id", "store_id || '/' || item_id",
                 _json(predicted_daily=_quoted(_fixed("predicted", 2)), model=_quoted("model"))),
        _section("risk_products", "(SELECT * FROM averages WHERE avg_sales <= (SELECT lo FROM cut))", 10,
                 "avg_sales, store_id, item_id", "store_id || '/' || item_id",
                 _json(avg_daily_sales=_quoted(_fixed("avg_sales", 2)))),
        _section("store_performance", "stores", 10, "total_sales DESC, store_id", "store_id",
                 _json(total_sales="CAST(total_sales AS VARCHAR)", avg_daily=_quoted(_fixed("avg_daily", 2)),
                       best_day="CAST(best_day AS VARCHAR)")),
        _section("category_breakdown", "categories", 5, "total_sales DESC, cat_id", "cat_id",
                 _json(n_products="CAST(n_products AS VARCHAR)", total_sales="CAST(total_sales AS VARCHAR)",
                       avg_daily=_quoted(_fixed("avg_daily", 2)))),
        _section("model_performance", "metrics", 10, "rmse, model", "model",
                 _json(rmse=_quoted(_fixed("rmse", 4)), mae=_quoted(_fixed("mae", 4)), rmsse=_quoted(_fixed("rmsse", 4)))),
        _ADVICE_SQL,
    ]), ctes=_REPORT),
}
