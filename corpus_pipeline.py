"""From raw documents to packed training sequences.

STAGES are applied in order. Each takes (spark, docs, sf_dir), where docs is what the
stage before has kept, and returns a frame that is written as Parquet and read again.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from swishline.llm import language, mixing, ngram_join, packing, quality
from swishline.llm.tables import ship, table
from swishline.sources.scratch import written


MIX_ROUNDS = 256  # parts of the mix that sequences keep apart


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network, trained on these documents, knows."""
    ship(spark)
    return language.accepted(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules, of hosts that do not fail as a whole."""
    ship(spark)
    return quality.accepted(docs)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group that similarity links."""
    ship(spark)
    return ngram_join.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents, stored in the order of the mix."""
    return mixing.in_mix_order(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in training sequences, which follow the mix.

    Spark does not read files back in the order of the mix, and documents have no column
    for it: it is derived again, from the same rows.
    """
    ship(spark)
    return packing.pack(mixing.in_mix_order(docs), rounds=MIX_ROUNDS)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("ngram_join", ngram_join_stage),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

# a trained network decides in the first stage and tokenizers cut in the last
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
