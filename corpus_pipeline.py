"""Corpus pipeline over ``documents``: quality rules, near-duplicates out,
personal data masked, token ids packed.

Each stage gets the rows that its predecessor kept, written as Parquet and read
again. All but the last return the columns that they got.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retail_signals.llm import ngram_join, packing, pii, quality
from retail_signals.llm.common import stage
from retail_signals.llm.queries import JSON, PATTERN, RANKS, documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of linked ones."""
    return ngram_join.deduplicate(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return pii.redact(docs)


def token_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces, with their ids, of sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, RANKS, PATTERN, JSON)


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicates),
          ("personal data", personal_data), ("packing", token_sequences)]

#: Tokenization and packing can't be written as SQL; tests/llm holds the pipeline
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over ``documents``."""
    docs = documents(spark, sf_dir)
    for _, step in STAGES[:-1]:
        docs, _ = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
