"""N-gram Jaccard join by a MinHash LSH forest and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import common, shingles
from panelspark.llm import words as W

TREES, LONGEST = 48, 8
RECALL = 0.9999


def matched_prefix(threshold: float, trees: int, longest: int, recall: float) -> tuple[int, float]:
    """The longest prefix at which a pair at the threshold still meets in some tree with the target recall.

    Starts from whole labels and shortens them step by step: two labels share d values with probability
    s**d, so the expected recall is 1 - (1 - s**d)**trees. Returns (length, recall reached).
    """
    for length in range(longest, 0, -1):
        reached = 1 - (1 - threshold**length) ** trees
        if reached >= recall:
            return length, reached
    return 1, reached


def labels(docs: DataFrame, text: str, doc_id: str, trees: int, longest: int) -> DataFrame:
    """(doc_id, key, label): a digest of the shingle set and its labels in all trees, 16 bits a value.

    Texts without words have no key.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    shape = "doc_id long, key binary, label binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = shingles.MinHash(trees * longest)
        for batch in batches:
            for lo, part in shingles.slices(batch.column(1)):
                some = list(shingles.sets(part))
                signature = W.mix(family.signatures(some)).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, len(part)),
                        pa.array([shingles.digest(s) if len(s) else None for s in some], pa.binary()),
                        pa.array([r.tobytes() if len(s) else None for r, s in zip(signature, some)], pa.binary()),
                    ],
                    names=["doc_id", "key", "label"],
                )

    return rows.mapInArrow(run, shape)


def candidates(labelled: DataFrame, trees: int, longest: int, length: int) -> DataFrame:
    """Links (a, b) from each document to the least one of every trie node of depth ``length`` it is in.

    A level of a tree's sorted prefix trie is a grouping by prefix. Nodes with one document go; of the
    others the least document is found with a pre-aggregated minimum, so neither copies nor a passage
    that many documents share bring a node together in one task, and a node gives a row per document, not
    per pair.
    """
    shape = "doc_id long, node long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16)
            prefix = raw.reshape(batch.num_rows, trees, longest)[:, :, :length].astype(np.uint64)
            node = np.broadcast_to(np.arange(trees, dtype=np.uint64), prefix.shape[:2]).copy()
            for i in range(length):
                node = W.mix(node * np.uint64(65537) + prefix[:, :, i])
            ids = np.repeat(np.asarray(batch.column(0)), trees)
            flat = node.view(np.int64).ravel()
            for lo in range(0, len(flat), 200_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo : lo + 200_000]), pa.array(flat[lo : lo + 200_000])], names=["doc_id", "node"]
                )

    nodes = labelled.where("key is not null and doc_id is not null").select("doc_id", "label").mapInArrow(run, shape)
    shared = nodes.groupBy("node").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    return nodes.join(shared.select("node", "least"), "node").where("doc_id > least").select(
        F.col("doc_id").alias("a"), F.col("least").alias("b")
    ).distinct()


def jaccard_join(
    docs: DataFrame, threshold: float = 0.8, *, text: str = "text", doc_id: str = "doc_id", trees: int = TREES,
    longest: int = LONGEST, recall: float = RECALL,
) -> DataFrame:
    """Documents linked by word-shingle similarity: doc_id, n_links, class_id, kept; a row per input row.

    Words are runs without white space, A-Z lower-cased; a shingle is five of them, a shorter text is one
    shingle. Documents meet in the forest's tries at the longest prefix that keeps the target recall; what
    meets forms candidate groups, inside which the distinct shingle sets are compared exactly. n_links
    counts other documents, copies among them; copies are a class with a weight and are never paired.
    class_id is the least doc_id reached by links, kept marks it. Texts without words, NULL texts and
    NULL ids link with nothing; rows that repeat a doc_id count as documents, under one id.
    """
    length, _ = matched_prefix(threshold, trees, longest, recall)
    labelled = common.stage(labels(docs, text, doc_id, trees, longest), "labels")
    groups = common.components(candidates(labelled, trees, longest, length))
    groups = groups.select(F.col("node").alias("doc_id"), F.col("component").alias("grp"))
    known = labelled.select("doc_id", "key").where("key is not null and doc_id is not null")
    # distinct shingle sets of a group, under their least document
    classes = common.stage(
        known.join(groups, "doc_id").groupBy("grp", "key").agg(
            F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("weight")
        ),
        "classes",
    )
    several = classes.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("grp")
    wanted = classes.join(several, "grp").select("grp", "node", "weight", "key")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, part in shingles.slices(batch.column(3)):
                rows = batch.slice(lo, len(part))
                some = list(shingles.sets(part))
                same = pa.array([shingles.digest(s) == k for s, k in zip(some, rows.column(4).to_pylist())], pa.bool_())
                found = pa.array([s.tobytes() for s in some], pa.binary())
                yield pa.RecordBatch.from_arrays([*rows.columns[:3], found], names=["grp", "node", "weight", "set"]).filter(same)

    texts = docs.select(F.col(doc_id).cast("long").alias("node"), F.col(text).cast("string").alias("text"))
    # the same join at every size: texts are exchanged once, and no list of ids has to fit a task
    items = texts.join(wanted.hint("merge"), "node").select("grp", "node", "weight", "text", "key")
    items = items.mapInArrow(read, "grp long, node long, weight long, set binary")
    linked = common.stage(shingles.verified(items, wanted, threshold), "verified")
    member = common.components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    outside = linked.groupBy("node").agg(F.sum("links").alias("outside"))
    about = (
        classes.join(outside, "node", "left")
        .join(member.withColumnRenamed("component", "class"), "node", "left")
        .select(
            "grp", "key", F.coalesce("class", "node").alias("class"),
            (F.coalesce("outside", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"),
        )
    )
    rows = labelled.select("doc_id", "key").join(groups, "doc_id", "left").join(about, ["grp", "key"], "left")
    found = F.coalesce("class", "doc_id")
    return rows.select(
        "doc_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), found.alias("class_id"),
        F.coalesce(F.col("doc_id") == found, F.lit(False)).alias("kept"),
    )
