"""The corpus pipeline: STAGES in order, each (name, function of spark, docs, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelspark.llm import common, stages

STAGES = [
    ("toxicity", stages.toxicity),
    ("ngram_jaccard", stages.ngram_jaccard),
    ("substring_dedup", stages.substring_dedup),
    ("best_fit_packing", stages.best_fit_packing),
]
#: A classifier, hashed signatures and a tokenizer are not expressible in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written as Parquet and read by the next."""
    docs = common.table(spark, sf_dir, "documents")
    for i, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = common.stage(docs, name)
    return docs
