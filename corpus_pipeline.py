"""The document pipeline: from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage before kept, and
returns a DataFrame that is written as Parquet and read again as the docs of the next. All stages
but the last return the columns of documents. Null and empty texts have too few words and go with
the quality rules; an empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelkit.llm import bpe, minhash, mixing, quality_rules, toxicity
from panelkit.llm.common import table
from panelkit.storage import stage

#: Near duplicates share this percentage of their five-word shingles, or more.
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned lexicon does not predict to be toxic."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the n-gram likelihood ratio."""
    trusted = quality_rules.trusted_ids(table(spark, sf_dir, "labels"))
    return quality_rules.kept_documents(docs, trusted)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.without_near_duplicates(docs, NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of each document of the mix."""
    return bpe.encode_documents(docs, bpe.default_tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", to_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each written before the next begins."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs


#: SQL cannot express the learned scores and the merges; the tests use brute force instead.
ORACLE_SQL = None
