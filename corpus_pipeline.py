"""The corpus pipeline: toxicity, exact dedup, near dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir); what it returns is written as Parquet in the shared checkpoint
folder and read again as the next stage's documents.  Empty tables, nulls, repeated rows and other columns are
handled as each operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, exact_dedup, ngram_join, packing, toxicity
from tidemark.llm.common import documents, materialize


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go; it learns from the given labels."""
    model = toxicity.fit(docs, documents(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the least id stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the least id stays."""
    return ngram_join.drop_near_copies(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.drop_leaks(docs, documents(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of training sequences."""
    return packing.digest(packing.pack_documents(docs))


STAGES = [("toxicity", toxic), ("exact_dedup", exact), ("ngram_join", near), ("decontamination", leaks),
          ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
