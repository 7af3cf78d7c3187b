"""The corpus pipeline: documents through quality rules, near duplicates, decontamination, surrogates and BPE.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. Between stages the
rows are written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from repopulse.llm import bpe_lexicon, decontaminate, jaccard_join, quality_rules, surrogates
from repopulse.session import settle

SURROGATE_KEY = "corpus surrogate key"
#: Hashed joins, keyed surrogates and merges by rank are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in place of personal data and secrets."""
    return surrogates.replace_entities(docs, SURROGATE_KEY).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids, decoded text and number of tokens."""
    return bpe_lexicon.encode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("n-gram jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("pii surrogates", private_data),
    ("bpe encoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
