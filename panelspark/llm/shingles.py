"""Word shingles, MinHash signatures and exact Jaccard similarity."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import words as W

SIZE = 5
#: Text worked on at a time.
SLICE = 1 << 20
#: Shingles whose hashes are formed together, about the size of a core's cache.
CACHE = 1 << 15
#: Items of small candidate groups that share a task.
TOGETHER = 1000
#: Items of a candidate group compared at a time; a larger group is worked off as pairs of such blocks.
BLOCK = 256
_WEIGHTS = W.mix(np.arange(1, SIZE + 1, dtype=np.uint64))


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, pa.Array]]:
    """(first row, part) of a column, in parts of about ``limit`` bytes."""
    _, offsets = W.column_bytes(column)
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, column.slice(at, stop - at)
        at = stop


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, offsets of the rows) of a column."""
    hashes, counts = [np.zeros(0, np.uint64)], np.zeros(len(column), np.int64)
    for part in W.words(*W.column_bytes(column)):
        hashes.append(part.hashes())
        if len(part.row):
            counts += np.bincount(part.row, minlength=len(column))
    return np.concatenate(hashes), np.concatenate([[0], np.cumsum(counts)])


def shingle_hashes(words: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Hashes of every run of ``size`` words; a shorter text is one shingle of all its words."""
    n = min(size, len(words))
    if not n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        total += words[j : len(words) - n + 1 + j] * _WEIGHTS[j]
    return W.mix(total + np.uint64(n))


def sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each row."""
    for _, part in slices(column):
        hashes, offsets = word_hashes(part)
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            yield np.unique(shingle_hashes(hashes[a:b]))


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


class MinHash:
    """Signatures of ``n`` values of 32 bits."""

    def __init__(self, n: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.add = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        self.times = rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

    def signatures(self, some: list[np.ndarray]) -> np.ndarray:
        """One row per set; an empty set has the largest value everywhere."""
        out = np.full((len(some), len(self.add)), np.uint32(0xFFFFFFFF))
        at = 0
        while at < len(some):
            stop, total = at, 0
            while stop < len(some) and (stop == at or total + len(some[stop]) <= CACHE):
                total += len(some[stop])
                stop += 1
            use = [i for i in range(at, stop) if len(some[i])]
            if use:
                flat = (np.concatenate([some[i] for i in use]) >> np.uint64(32)).astype(np.uint32)
                starts = np.concatenate([[0], np.cumsum([len(some[i]) for i in use])[:-1]])
                buffer = np.empty_like(flat)
                found = np.empty((len(self.add), len(use)), np.uint32)
                for k in range(len(self.add)):
                    np.bitwise_xor(flat, self.add[k], out=buffer)
                    np.multiply(buffer, self.times[k], out=buffer)
                    np.minimum.reduceat(buffer, starts, out=found[k])
                out[use] = found.T
            at = stop
        return out


def shared_counts(some: list[np.ndarray]) -> np.ndarray:
    """Number of common elements of every two sets, by products of membership matrices."""
    n = len(some)
    flat = np.concatenate(some)
    owner = np.repeat(np.arange(n), [len(s) for s in some])
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    names, column = np.unique(column[shared], return_inverse=True)
    owner = owner[shared]
    total = np.zeros((n, n), np.float64)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for lo in range(0, len(names), 8192):
        a, b = np.searchsorted(column, (lo, lo + 8192))
        member = np.zeros((n, min(8192, len(names) - lo)), np.float32)
        member[owner[a:b], column[a:b] - lo] = 1
        total += member @ member.T
    return total


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each node's component under links (a, b)."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def verified(items: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """Exact links inside candidate groups: (node, root, links) for every item that has one.

    ``items``: grp (long), node (long), weight (long: copies it stands for), set (binary of sorted 64-bit
    hashes). ``members``: a narrow table with a row of grp for each of them, for the sizes of the groups. ``links`` is the weight of the partners found; (node, root) connects what is linked. All pairs
    of a group are compared, so a pair that only met through others counts as well. Groups up to BLOCK
    items are worked off together, about TOGETHER items to a task; a larger one as pairs of blocks of its items, each in a group of
    its own, so the rows exchanged grow with size / BLOCK, and no pair leaves a task as a row.
    """
    sizes = members.groupBy("grp").agg(F.count(F.lit(1)).alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    tasks = max(64, members.count() // TOGETHER)
    dealt = (
        items.join(sizes, "grp")
        .withColumn("blocks", blocks)
        .withColumn("block", F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("node"), "blocks")).otherwise(0).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "grp", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"), "block",
            "node", "weight", "set", "blocks",
        )
        .withColumn("task", F.when(F.col("blocks") > 1, F.xxhash64("grp", "b1", "b2")).otherwise(F.pmod(F.xxhash64("grp"), F.lit(tasks))))
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, b1, b2), own in frame.groupby(["grp", "b1", "b2"], sort=True):
            own = own.drop_duplicates(["node", "set"]).sort_values("node")  # rows that repeat an id
            some = [np.frombuffer(s, np.uint64) for s in own["set"]]
            size = np.array([len(s) for s in some], float)
            both = shared_counts(some)
            hit = both >= threshold * (size[:, None] + size - both) - 1e-9
            hit &= (size > 0)[:, None]
            if b1 != b2:
                block = own["block"].to_numpy()
                hit &= block[:, None] != block
            a, b = np.nonzero(np.triu(hit, 1))
            if len(a):
                weight = own["weight"].to_numpy()
                links = np.bincount(a, weight[b], len(own)) + np.bincount(b, weight[a], len(own))
                node = own["node"].to_numpy()
                found = pd.DataFrame({"node": node, "root": node[forest(len(own), a, b)], "links": links.astype("int64")})
                out.append(found[links > 0])
        return pd.concat(out) if out else pd.DataFrame({"node": [], "root": [], "links": []}).astype("int64")

    return dealt.drop("blocks").groupBy("task").applyInPandas(compare, "node long, root long, links long")
