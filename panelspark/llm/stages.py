"""The pipeline's stages: each takes (spark, docs, sf_dir) and works on all rows of ``docs``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import common, lsh_forest, packing, paragraphs, queries
from panelspark.llm import toxicity as classifier
from panelspark.session import ship_package

CAPACITY = 2048


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier doesn't find toxic; it learns from the labels of these documents.

    NULL and empty texts are judged by the bias alone, repeated rows alike; without labels nothing goes.
    """
    ship_package(spark)
    labels = common.table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = classifier.train(docs, labels, queries.held_out_of_toxicity)
    return classifier.accepted(docs, model)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of linked documents.

    Only ids are joined to the documents: those that go. Rows without doc_id stay; of rows that repeat a
    kept doc_id each stays.
    """
    ship_package(spark)
    linked = lsh_forest.jaccard_join(docs)
    name = common.fresh("gone", docs.columns)
    gone = linked.where("not kept and doc_id is not null").select(F.col("doc_id").alias(name)).distinct()
    gone = common.stage(gone, "gone")
    return docs.join(gone.hint("merge"), F.col("doc_id").cast("long") == F.col(name), "left_anti")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has; n_chars is that of the text left."""
    ship_package(spark)
    spans = common.stage(paragraphs.repeated_passages(docs), "spans")
    cut = paragraphs.without_passages(docs, spans)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return cut.select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, in sequences of at most CAPACITY ids.

    NULL and empty texts are one id, the end; repeated rows and rows without doc_id are packed each.
    """
    ship_package(spark)
    definition = queries.vocabulary("byte_bpe_50k.json")
    pieces = common.stage(packing.document_pieces(docs, definition, 0, CAPACITY), "pieces")
    return packing.pack(pieces, CAPACITY)
