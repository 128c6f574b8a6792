"""Near-duplicate vectors: an exact metric range join over pivot cells."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import common, vectors

#: Rows of a cell compared at a time; a larger cell is worked off as pairs of such blocks.
BLOCK = 1024
MAX_PIVOTS = 4096
#: Vectors the number of pivots is chosen on, and comparisons that one more row in an exchange costs.
SAMPLE, ROW = 2048, 2000


def _vectors(df: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(vec_id, label, key, vec): unit vectors as binary doubles and a digest of the original; NULL if unusable."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, units = [], []
            for v in vectors.usable(batch.column(2)):
                keys.append(None if v is None else hashlib.blake2b((v + 0.0).tobytes(), digest_size=16).digest())
                units.append(None if v is None else vectors.unit(v).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(units, pa.binary())],
                names=["vec_id", "label", "key", "vec"],
            )

    rows = df.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(embedding).alias("e")
    )
    return rows.mapInArrow(run, "vec_id long, label string, key binary, vec binary")


def _reach(d: np.ndarray, between: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """(nearest pivot, lower-numbered cells to be copied to) of vectors at distances ``d`` from the pivots."""
    slack = 1e-6
    home = d.argmin(1)
    near = d[np.arange(len(d)), home][:, None]
    reach = (d - near <= 2 * radius + slack) & (d * d - near * near <= 2 * between[home] * (radius + slack))
    return home, reach & (np.arange(d.shape[1]) < home[:, None])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * x @ pivots.T))


def best_number(sample: np.ndarray, pivots: np.ndarray, radius: float, n: int, labels: int) -> int:
    """How many of the pivots to use: the least estimated cost of copies and comparisons for ``n`` vectors.

    More pivots make smaller cells but more copies at their borders; which wins depends on how clustered
    the vectors are. The result is exact with any number.
    """
    d, between = _distances(sample, pivots), _distances(pivots, pivots)
    costs, size = {}, 1
    while size <= len(pivots):
        home, reach = _reach(d[:, :size], between[:size, :size], radius)
        own = np.bincount(home, minlength=size) / len(sample)
        everyone = own + reach.sum(0) / len(sample)
        costs[size] = ROW * n * everyone.sum() + n * n / labels * float(own @ everyone)
        size *= 2
    return min(costs, key=costs.get)


def _deal(pivots: np.ndarray, radius: float):
    """Cells of each vector: its nearest pivot's, and lower-numbered ones it may have partners in.

    Let a partner's nearest pivot be i and the vector's own be h. By the triangle inequality
    d(v, i) <= d(v, h) + 2 r, and the way between them crosses the plane halfway between the pivots,
    so the distance to it, (d(v, i)^2 - d(v, h)^2) / (2 d(i, h)), is at most r as well. A pair that lies
    in two cells is found in the lower-numbered one.
    """
    between = _distances(pivots, pivots)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if frame.empty:
                continue
            for lo in range(0, len(frame), 2048):
                part = frame.iloc[lo : lo + 2048]
                same = part["vec"].str.len() == pivots.shape[1] * 8
                for own, fits in ((part[same], True), (part[~same], False)):
                    if own.empty:
                        continue
                    if not fits:  # other lengths than the pivots': a cell per length
                        size = own["vec"].str.len()
                        yield own.assign(cell=-size.astype("int64"), home=True)
                        continue
                    x = vectors.matrix(own["vec"].tolist())
                    home, reach = _reach(_distances(x, pivots), between, radius)
                    row, cell = np.nonzero(reach)
                    yield own.assign(cell=home.astype("int64"), home=True)
                    yield own.iloc[row].assign(cell=cell.astype("int64"), home=False)

    return run


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
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


def near_vectors(
    df: DataFrame, threshold: float, *, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """Vectors of equal, non-null label whose cosine is at least ``threshold``; one row per input row.

    Returns vec_id, n_links, component_id (the least vec_id reached) and kept. Equal vectors are one class
    with a weight, so copies are never paired; of a class, the least vec_id stands for it. NULL labels and
    vectors that are NULL, empty, zero or hold NULL or non-finite parts link with nothing, and vectors of
    different lengths not with each other. Repeated rows count as further vectors; a NULL vec_id has links
    but is no component. Pivots are a hash sample of at most the square root of the classes and
    MAX_PIVOTS; how many of them are used is chosen on SAMPLE vectors. The driver gets nothing else.
    """
    spark = df.sparkSession
    rows = _vectors(df, vec_id, embedding, label)
    good = rows.where("label is not null and key is not null")
    classes = common.stage(
        good.groupBy("label", "key").agg(
            F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("vec").alias("vec")
        ),
        "vector-classes",
    )
    n, labels = classes.agg(F.count(F.lit(1)), F.approx_count_distinct("label")).first()
    size = min(MAX_PIVOTS, max(1, math.isqrt(n)))
    found = classes.select("vec").orderBy(F.xxhash64("vec")).limit(size).collect()
    radius = math.sqrt(max(0.0, 2 - 2 * threshold))
    width = max((len(r.vec) for r in found), default=8)
    pivots = vectors.matrix([bytes(r.vec) for r in found if len(r.vec) == width] or [bytes(8)])
    some = classes.where(F.length("vec") == width).select("vec").orderBy(F.xxhash64("vec", F.lit(1))).limit(SAMPLE).collect()
    if some:
        x = vectors.matrix([bytes(r.vec) for r in some])
        pivots = pivots[: best_number(x, pivots, radius, n, max(1, labels))]
    dealt = common.stage(
        classes.mapInPandas(
            _deal(pivots, radius), "label string, key binary, rep long, weight long, vec binary, cell long, home boolean"
        ),
        "vector-cells",
    )
    blocks = dealt.groupBy("label", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    cells = (
        dealt.join(blocks, ["label", "cell"])
        .withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "label", "cell", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"),
            "block", "key", "rep", "weight", "vec", "home",
        )
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["block", "key"], ignore_index=True)
        x, home = vectors.matrix(frame["vec"].tolist()), frame["home"].to_numpy()
        weight, block = frame["weight"].to_numpy(), frame["block"].to_numpy()
        same = frame["b1"][0] == frame["b2"][0]
        left, right, cut = [], [], len(x) if same else int((block == frame["b1"][0]).sum())
        for lo in range(0, cut, 512):
            hi = min(cut, lo + 512)
            cosine = x[lo:hi] @ (x.T if same else x[cut:].T)
            a, b = np.nonzero(cosine >= threshold)
            a, b = a + lo, b + (0 if same else cut)
            keep = (home[a] | home[b]) & ((a < b) if same else True)
            left.append(a[keep])
            right.append(b[keep])
        a, b = np.concatenate(left or [np.zeros(0, int)]), np.concatenate(right or [np.zeros(0, int)])
        links = np.bincount(a, weight[b], len(x)) + np.bincount(b, weight[a], len(x))
        root = _forest(len(x), a, b)
        out = frame.assign(links=links.astype("int64"), root=frame["rep"].to_numpy()[root])
        return out.loc[links > 0, ["label", "key", "rep", "root", "links"]]

    linked = common.stage(
        cells.groupBy("label", "cell", "b1", "b2").applyInPandas(
            compare, "label string, key binary, rep long, root long, links long"
        ),
        "vector-links",
    )
    member = common.components(linked.select(F.col("rep").alias("a"), F.col("root").alias("b")).where("a is not null and b is not null"))
    outside = linked.groupBy("label", "key").agg(F.sum("links").alias("outside"))
    about = classes.drop("vec").join(outside, ["label", "key"], "left").join(
        member, classes["rep"] == member["node"], "left"
    )
    about = about.select(
        "label", "key",
        (F.coalesce("outside", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"),
        F.coalesce("component", "rep").alias("component"),
    )
    result = rows.select("vec_id", "label", "key").join(about, ["label", "key"], "left")
    component = F.coalesce("component", "vec_id")
    return result.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
