"""Token ids of documents as flat binary files with 64-bit offsets, and their memory-mapped reader.

Layout of a folder: ``shard-N.ids`` holds the ids of its documents one after another as little-endian
unsigned integers of 2 or 4 bytes, ``shard-N.offsets`` one more 64-bit number than it has documents,
``shard-N.docs`` their 64-bit document ids and ``shard-N.known`` a byte each that is 0 where the document
id is NULL. Shards follow the order of document ids. ``manifest.json`` names the width and, per shard, its
documents, ids and base: the number of ids of all shards before it, from a prefix sum over the shards.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import common, vocab

SPANS = "doc_id long, start long, n_tokens long, ids_crc32 long, shard int"


def _atomic(path: str, attempt: int, parts) -> None:
    """Write and rename, so that a repeated or speculative task leaves one whole file."""
    temporary = f"{path}.{attempt}"
    with open(temporary, "wb") as f:
        for part in parts:
            f.write(part)
    os.replace(temporary, path)


def write_token_files(
    docs: DataFrame, definition: bytes, end_id: int, folder: str, *, text: str = "text", doc_id: str = "doc_id"
) -> dict:
    """Encode whole texts and write them in ascending order of document id; returns the manifest.

    Documents are dealt by ranges of their id and sorted inside, then encoded and written where they
    lie: one exchange of texts, no exchange of ids. NULL texts are empty and get only ``end_id``; NULL
    document ids come first; repeated rows are written each, in the order of their texts' hashes.
    The driver gets one small row per shard and forms the bases from them.
    """
    width = 2 if max(vocab.vocabulary_size(definition), end_id + 1) <= 1 << 16 else 4
    spark = docs.sparkSession
    source = spark.sparkContext.broadcast(definition)
    path = common.mounted(folder)
    os.makedirs(path, exist_ok=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocab.encoder(source.value, spaced=False)
        context = TaskContext.get()
        shard, attempt = context.partitionId(), context.taskAttemptId()
        ids_path = f"{path}/shard-{shard:06d}.ids"
        lengths, known, keys, ids_file = [], [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            if ids_file is None:
                os.makedirs(path, exist_ok=True)
                ids_file = open(f"{ids_path}.{attempt}", "wb")
            ids, counts = encode.encode(batch.column(1))
            spots = np.cumsum(counts)
            ids_file.write(np.insert(ids, spots, end_id).astype(f"<u{width}").tobytes())
            lengths.append(counts + 1)
            known.append(np.asarray(batch.column(0).is_valid()).astype(np.uint8))
            keys.append(np.asarray(batch.column(0).fill_null(0)).astype("<i8"))
        if ids_file is None:
            return
        ids_file.close()
        os.replace(f"{ids_path}.{attempt}", ids_path)
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype("<i8")
        _atomic(f"{path}/shard-{shard:06d}.offsets", attempt, [offsets.tobytes()])
        _atomic(f"{path}/shard-{shard:06d}.docs", attempt, [k.tobytes() for k in keys])
        _atomic(f"{path}/shard-{shard:06d}.known", attempt, [k.tobytes() for k in known])
        yield pa.RecordBatch.from_pydict(
            {"shard": pa.array([shard], pa.int32()), "docs": [len(offsets) - 1], "ids": [int(offsets[-1])]}
        )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    tie = F.xxhash64("text")
    dealt = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    shards = sorted(dealt.mapInArrow(write, "shard int, docs long, ids long").collect())
    bases = np.concatenate([[0], np.cumsum([s.ids for s in shards])]).astype(int).tolist()
    manifest = {
        "width": width,
        "end_id": end_id,
        "shards": [
            {"shard": s.shard, "docs": s.docs, "ids": s.ids, "base": base} for s, base in zip(shards, bases)
        ],
    }
    _atomic(f"{path}/manifest.json", 0, [json.dumps(manifest).encode()])
    return manifest


class TokenFiles:
    """Random access to the documents of one shard, memory-mapped."""

    def __init__(self, path: str, shard: dict, width: int):
        name = f"{path}/shard-{shard['shard']:06d}"
        self.ids = np.memmap(f"{name}.ids", f"<u{width}", "r") if shard["ids"] else np.zeros(0, f"<u{width}")
        self.offsets = np.memmap(f"{name}.offsets", "<i8", "r")
        self.docs = np.memmap(f"{name}.docs", "<i8", "r")
        self.known = np.memmap(f"{name}.known", np.uint8, "r")
        self.base = shard["base"]

    def __len__(self) -> int:
        return len(self.docs)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.ids[self.offsets[i] : self.offsets[i + 1]]


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document: where its ids start among all, how many they are and their checksum.

    The checksum is the unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers.
    """
    path = common.mounted(folder)
    with open(f"{path}/manifest.json") as f:
        manifest = json.load(f)
    shards, width = manifest["shards"], manifest["width"]
    if not shards:
        return spark.createDataFrame([], SPANS)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i in frame["id"]:
                files = TokenFiles(path, shards[i], width)
                for lo in range(0, len(files), 50_000):
                    hi = min(lo + 50_000, len(files))
                    start = files.offsets[lo:hi] + files.base
                    yield pd.DataFrame(
                        {
                            "doc_id": pd.array(files.docs[lo:hi], "Int64").copy()
                            if files.known[lo:hi].all()
                            else pd.Series(files.docs[lo:hi]).astype("Int64").where(files.known[lo:hi] > 0),
                            "start": start,
                            "n_tokens": np.diff(files.offsets[lo : hi + 1]),
                            "ids_crc32": [zlib.crc32(files[d].astype("<u4")) for d in range(lo, hi)],
                            "shard": np.int32(shards[i]["shard"]),
                        }
                    )

    n = len(shards)
    return spark.range(0, n, 1, min(n, 20_000)).mapInPandas(read, SPANS)
