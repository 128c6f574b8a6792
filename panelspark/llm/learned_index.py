"""Nearest neighbours by learned partitions of a neighbour graph."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelspark.llm import common, vectors

#: Vectors the index is fitted on, a part's share of them with more parts, and the bound of what the driver gets.
SAMPLE, SHARE, LARGEST = 4096, 128, 16384
#: Parts at least, and rows of a part from which on the table gets more of them, until the sample's bound is reached.
PARTS, FULL = 16, 8192
#: Rows of a part, and queries of a part, that one task holds.
BLOCK = 8192


@dataclass
class Router:
    """A small classifier from a vector to the probability of each part."""

    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    probes: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum(scaled(x, self.mean, self.scale) @ w1 + b1, 0) @ w2 + b2

    def best(self, x: np.ndarray, n: int) -> np.ndarray:
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, :n]

    def enough(self, x: np.ndarray, wanted: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every vector's parts, likeliest first, and how many of them to probe: ``probes``, and further ones
        until they hold ``wanted`` rows together (``held``: rows of each part)."""
        order = self.best(x, len(held))
        short = (np.cumsum(held[order], axis=1) < wanted[:, None]).sum(1)
        return order, np.minimum(np.maximum(self.probes, short + 1), len(held))


def scaled(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised components; what overflows ends at a bound, so that routing stays defined."""
    with np.errstate(all="ignore"):
        return np.clip(np.nan_to_num((x - mean) / scale), -1e6, 1e6)


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of ``x`` from ``q``; where squares overflow, of scaled differences."""
    with np.errstate(over="ignore"):
        d = np.sqrt(((x - q) ** 2).sum(1))
        far = np.flatnonzero(np.isinf(d))
        if len(far):
            half = x[far] / 2 - q / 2
            top = np.abs(half).max(1)
            d[far] = 2 * top * np.sqrt(((half / top[:, None]) ** 2).sum(1))
    return d


def number_of_parts(rows: int) -> int:
    """A power of two: PARTS, doubled while the parts would be fuller than FULL and the sample has its share for each."""
    parts = PARTS
    while parts * FULL < rows and 2 * parts * SHARE <= LARGEST:
        parts *= 2
    return parts


def neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of each row, by brute force."""
    out = np.empty((len(x), min(k, len(x) - 1)), np.int64)
    square = (x * x).sum(1)
    for lo in range(0, len(x), 512):
        d = square[lo : lo + 512, None] + square - 2 * x[lo : lo + 512] @ x.T
        d[np.arange(len(d)), np.arange(lo, lo + len(d))] = np.inf
        out[lo : lo + 512] = np.argsort(d, axis=1, kind="stable")[:, : out.shape[1]]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.1) -> np.ndarray:
    """Parts of about equal size that cut few edges of the neighbour graph.

    Starts from halves along the main direction of each half, then moves vertices to the part most of
    their neighbours are in while that part has room.
    """
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        halves = []
        for g in groups:
            centred = x[g] - x[g].mean(0)
            direction = np.linalg.svd(centred.T @ centred)[0][:, 0]
            order = g[np.argsort(centred @ direction, kind="stable")]
            halves += [order[: len(order) // 2], order[len(order) // 2 :]]
        groups = halves
    part = np.empty(len(x), np.int64)
    for i, g in enumerate(groups):
        part[g] = i
    both = [[] for _ in range(len(x))]
    for a, row in enumerate(graph.tolist()):
        for b in row:
            both[a].append(b)
            both[b].append(a)
    room, held = int(slack * len(x) / parts) + 1, np.bincount(part, minlength=parts)
    for _ in range(rounds):
        moved = 0
        for v in range(len(x)):
            votes = np.bincount(part[both[v]], minlength=parts)
            votes[held >= room] = 0
            new, old = int(votes.argmax()), int(part[v])
            if votes[new] > np.count_nonzero(part[both[v]] == old):
                part[v], moved = new, moved + 1
                held[old] -= 1
                held[new] += 1
        if not moved:
            break
    return part


def train(x: np.ndarray, target: np.ndarray, hidden: int = 128, epochs: int = 60, seed: int = 7) -> list[np.ndarray]:
    """One hidden layer, cross entropy against soft targets, Adam."""
    rng = np.random.default_rng(seed)
    parts = target.shape[1]
    w = [
        rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
        rng.normal(0, np.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts),
    ]
    m, v, t = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    for epoch in range(epochs):
        rate = 3e-3 * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        order = rng.permutation(len(x))
        for lo in range(0, len(x), 256):
            i = order[lo : lo + 256]
            h = np.maximum(x[i] @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(1, keepdims=True))
            g = (p / p.sum(1, keepdims=True) - target[i]) / len(i)
            gh = (g @ w[2].T) * (h > 0)
            t += 1
            for k, grad in enumerate((x[i].T @ gh + 1e-4 * w[0], gh.sum(0), h.T @ g + 1e-4 * w[2], g.sum(0))):
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                w[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return w


def fit(x: np.ndarray, k: int, parts: int, target_recall: float = 0.97) -> Router:
    """Graph, parts and classifier of a sample; probes is the least number that reaches the recall on it.

    Probes are chosen on vectors the classifier wasn't trained on, against their true neighbours.
    """
    with np.errstate(all="ignore"):
        mean, scale = x.mean(0), x.std(0) + 1e-12
    z = scaled(x, mean, scale)
    held = np.arange(len(x)) % 5 == 4
    if len(x) <= 50 or parts == 1:
        w = [np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, parts)), np.zeros(parts)]
        return Router(mean, scale, w, parts)
    base = x[~held]
    graph = neighbours(base, k)
    part = balanced_parts(z[~held], graph, parts)
    target = np.zeros((len(base), parts))
    np.add.at(target, (np.arange(len(base)), part), 0.5)
    np.add.at(target, (np.repeat(np.arange(len(base)), graph.shape[1]), part[graph].ravel()), 0.5 / graph.shape[1])
    router = Router(mean, scale, train(z[~held], target), parts)
    tests = x[held][:400]
    rank = np.argsort(np.argsort(-router.scores(tests), axis=1, kind="stable"), axis=1)
    home = router.best(x, 1)[:, 0]
    square = (x * x).sum(1)
    d = (tests * tests).sum(1)[:, None] + square - 2 * tests @ x.T
    near = np.argsort(d, axis=1, kind="stable")[:, 1 : k + 1]
    needed = np.take_along_axis(rank, home[near], 1).ravel()
    for probes in range(1, parts + 1):
        if (needed < probes).mean() >= target_recall:
            break
    router.probes = probes
    return router


def nearest(
    df: DataFrame, is_query, k: int, *, vec_id: str = "vec_id", embedding: str = "embedding",
    parts: int | None = None,
) -> DataFrame:
    """The k nearest rows of every query row by Euclidean distance: query_id, rank, vec_id, score.

    The index is fitted on a hash sample of SAMPLE vectors (SHARE a part, LARGEST at most, where
    ``number_of_parts`` gives more parts), but every row is put into the part the classifier finds most
    probable, and a query is compared with all rows of its ``probes`` most probable parts on the original
    vectors in double precision; where these hold fewer than k other rows, further parts are probed until
    they do. Ties go to the smaller vec_id. Vectors of another length than the sample's most common one
    are compared among their own length, all with all. Vectors that are NULL, zero or hold NULL or
    non-finite parts take no part, nor do NULL ids; a query never finds rows of its own vec_id, and a
    vec_id in several query rows is one query, with the least of their vectors by their bytes. A part
    larger than BLOCK rows, or with more queries, is worked off in blocks.
    """
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [None if v is None else v.tobytes() for v in vectors.usable(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary()), batch.column(2)], names=["vec_id", "vec", "query"]
            )

    rows = df.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("e"), is_query.alias("query")
    ).where("vec_id is not null")
    rows = common.stage(
        rows.mapInArrow(clean, "vec_id long, vec binary, query boolean").where("vec is not null"), "vectors"
    )
    answer = "query_id long, vec_id long, score double"
    parts = parts or number_of_parts(rows.count())
    wanted = max(SAMPLE, min(LARGEST, SHARE * parts))
    sample = rows.select("vec").orderBy(F.xxhash64("vec_id"), "vec").limit(wanted).collect()
    if not sample:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lengths = np.array([len(r.vec) for r in sample])
    width = int(np.bincount(lengths).argmax())
    x = vectors.matrix([bytes(r.vec) for r in sample if len(r.vec) == width])
    router = fit(x, k, parts if len(x) >= 20 * parts else 1)
    parts = len(router.layers[3])

    # other lengths have parts of their own, after those of the router
    def store(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            length = frame["vec"].str.len().to_numpy(np.int64)
            part, usual = parts + length // 8, length == width
            if usual.any():
                part[usual] = router.best(vectors.matrix(frame["vec"][usual].tolist()), 1)[:, 0]
            yield frame.assign(part=part.astype(np.int32))

    shape = "vec_id long, vec binary, part int"
    data = common.stage(rows.select("vec_id", "vec").mapInPandas(store, shape), "parts")
    held = np.zeros(parts, np.int64)
    for r in data.where(F.col("part") < parts).groupBy("part").count().collect():
        held[r.part] = r["count"]

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            usual = (frame["vec"].str.len() == width).to_numpy()
            other = frame[~usual]
            yield other.assign(part=(parts + other["vec"].str.len() // 8).astype(np.int32))[["vec_id", "vec", "part"]]
            frame = frame[usual]
            if len(frame):
                order, n = router.enough(vectors.matrix(frame["vec"].tolist()), k + frame["own"].to_numpy(), held)
                chosen = order[np.arange(parts) < n[:, None]]
                yield frame.loc[frame.index.repeat(n)].assign(part=chosen.astype(np.int32))[["vec_id", "vec", "part"]]

    # one query an id, with the number of its rows, which it doesn't find
    asked = rows.groupBy("vec_id").agg(
        F.min(F.when(F.col("query"), F.col("vec"))).alias("vec"), F.count(F.lit(1)).alias("own")
    ).where("vec is not null").mapInPandas(route, shape)
    size = lambda frame, name: frame.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))
    blocks = size(data, "n_data").join(size(asked, "n_asked"), "part")
    data = (
        data.join(blocks, "part")
        .withColumn("d", F.pmod(F.xxhash64("vec_id", "vec"), "n_data").cast("int"))
        .withColumn("q", F.explode(F.sequence(F.lit(0), F.col("n_asked") - 1)))
    )
    asked = (
        asked.join(blocks, "part")
        .withColumn("q", F.pmod(F.xxhash64("vec_id"), "n_asked").cast("int"))
        .withColumn("d", F.explode(F.sequence(F.lit(0), F.col("n_data") - 1)))
    )

    def search(queries: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(base):
            x, ids = vectors.matrix(base["vec"].tolist()), base["vec_id"].to_numpy()
            for q, raw in zip(queries["vec_id"].tolist(), queries["vec"].tolist()):
                d = distances(x, np.frombuffer(raw))
                own = ids == q
                d[own] = np.inf
                some = np.flatnonzero(d <= np.partition(d, min(k, len(d)) - 1)[min(k, len(d)) - 1])
                some = some[~own[some]]
                some = some[np.lexsort((ids[some], d[some]))][:k]
                found.append(pd.DataFrame({"query_id": q, "vec_id": ids[some], "score": d[some]}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    keys = ["part", "d", "q"]
    pairs = asked.select(*keys, "vec_id", "vec").groupBy(*keys).cogroup(
        data.select(*keys, "vec_id", "vec").groupBy(*keys)
    ).applyInPandas(search, answer)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
