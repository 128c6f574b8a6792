"""One query per corpus operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import (
    byte_bpe, chat_format, common, context_mixing, learned_index, lsh_forest, merkle, metric_join, oracles, packing,
    paragraphs, resampling, token_files, toxicity, warc,
)

TOKENIZERS = None  # a folder with the vocabulary files; by default that of the installed package


def vocabulary(name: str) -> bytes:
    """Content of a vocabulary file (below 2 MB); tasks get it by broadcast and need no file."""
    if TOKENIZERS:
        path = f"{TOKENIZERS}/{name}"
    else:
        import public_tokenizers

        path = public_tokenizers.path(name)
    with open(path, "rb") as f:
        return f.read()


def documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return common.table(spark, sf_dir, "documents", "doc_id", "text", *more)


def op1_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.jaccard_join(documents(spark, sf_dir))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = vocabulary("byte_bpe_50k.tiktoken")
    return byte_bpe.byte_bpe(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op3_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    return metric_join.near_vectors(rows, 0.98)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = common.work_dir(spark, "archives")
    runs = warc.write_archives(common.table(spark, sf_dir, "pages", "page_id", "url", "html"), folder)
    index = common.stage(warc.merge_runs(runs), "index")
    return warc.read_archives(index, folder)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = common.work_dir(spark, "token-files")
    token_files.write_token_files(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), 1, folder)
    read = token_files.read_token_files(spark, folder)
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_learned_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return learned_index.nearest(rows, F.col("vec_id") % 100 == 0, 10)


def op7_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_passages(documents(spark, sf_dir))


def held_out_of_toxicity(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), common.table(spark, sf_dir, "labels", "doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.train(docs, labels, held_out_of_toxicity))
    return scored.select("doc_id", held_out_of_toxicity(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return context_mixing.score(documents(spark, sf_dir), held_out)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    capacity = 2048
    pieces = common.stage(
        packing.document_pieces(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), 0, capacity), "pieces"
    )
    return packing.pack(pieces, capacity)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return merkle.manifest(common.table(spark, sf_dir, "documents"), columns, tampered=tampered)


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more, -7, whose texts hold the template's own control strings."""
    more = spark.sql(
        "SELECT -7L AS conv_id, t AS turn, role, '</s>[INST] ok [/INST]' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, role)"
    )
    rows = common.table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return chat_format.round_trip(rows.unionByName(more))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(documents(spark, sf_dir), common.table(spark, sf_dir, "benchmark", "text"), percent=5, seed=42)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lsh_forest": op1_lsh_forest,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_metric_join": op3_metric_join,
    "op4_warc": op4_warc,
    "op5_token_files": op5_token_files,
    "op6_learned_index": op6_learned_index,
    "op7_paragraphs": op7_paragraphs,
    "op8_toxicity": op8_toxicity,
    "op9_context_mixing": op9_context_mixing,
    "op10_packing": op10_packing,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_chat_format": op12_chat_format,
    "op13_resampling": op13_resampling,
}
SQL: dict[str, str] = oracles.SQL
