"""Packing of documents into sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import bisect
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import common, vocab

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, uid long"
#: Open pieces of one packing problem; islands hold whole problems of about this many.
PROBLEM = 2_000


def document_pieces(
    docs: DataFrame, definition: bytes, end_id: int, capacity: int, *, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Pieces of all documents: ids and ``end_id``, cut into runs of ``capacity`` if longer.

    The first piece takes what doesn't fill a run. NULL texts are empty: one id, ``end_id``. Rows with a NULL
    id and rows that repeat are documents of their own; an empty table gives none.
    ``uid`` numbers the pieces; it is arbitrary, so the result has to be staged before it is used.
    """
    source = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocab.encoder(source.value, spaced=True)
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, counts = encode.encode(batch.column(1))
            keys = batch.column(0).to_pylist()
            rows, at = [], 0
            for key, count in zip(keys, counts.tolist()):
                own = np.append(ids[at : at + count], end_id).astype("<u4")
                at += count
                lo, hi = 0, (len(own) - 1) % capacity + 1
                piece = 0
                while lo < len(own):
                    rows.append((key, piece, lo, hi - lo, zlib.crc32(own[lo:hi]), uid))
                    lo, hi, piece, uid = hi, hi + capacity, piece + 1, uid + 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            columns = zip(*rows) if rows else [[]] * 6
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "uid"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES)


class Bins:
    """One solution: bins of item numbers with their fill."""

    def __init__(self, bins: list[list[int]], fill: list[int]):
        self.bins, self.fill = bins, fill

    def worth(self, capacity: int) -> tuple[int, float]:
        """Fewer bins first, then fuller ones (mean square of the fill)."""
        return -len(self.bins), float(sum(f * f for f in self.fill)) / (capacity * capacity)


def best_fit(items: list[int], sizes: list[int], capacity: int, base: Bins | None = None) -> Bins:
    """Put items, in the given order, each into the fullest bin that can take it."""
    bins = [list(b) for b in base.bins] if base else []
    fill = list(base.fill) if base else []
    free = sorted((capacity - f, i) for i, f in enumerate(fill))
    for item in items:
        size = sizes[item]
        at = bisect.bisect_left(free, (size, -1))
        if at == len(free):
            bins.append([item])
            fill.append(size)
            room, where = capacity - size, len(bins) - 1
        else:
            room, where = free.pop(at)
            bins[where].append(item)
            fill[where] += size
            room -= size
        if room:
            bisect.insort(free, (room, where))
    return Bins(bins, fill)


def crossover(a: Bins, b: Bins, sizes: list[int], capacity: int, rng: random.Random, share: float) -> Bins:
    """Inject whole well-filled bins of ``b`` into ``a``; what they displace is put back by best fit."""
    order = sorted(range(len(b.bins)), key=lambda i: (-b.fill[i], rng.random()))
    take = order[: max(1, int(share * len(order)))]
    take = [i for i in take if rng.random() < 0.7] or take[:1]
    inside = {x for i in take for x in b.bins[i]}
    bins, fill, loose = [list(b.bins[i]) for i in take], [b.fill[i] for i in take], []
    for own, full in zip(a.bins, a.fill):
        if inside.isdisjoint(own):
            bins.append(own)
            fill.append(full)
        else:
            loose += [x for x in own if x not in inside]
    # open up the emptiest bins as well, or nothing could ever close one
    for i in sorted(range(len(take), len(bins)), key=lambda i: fill[i])[: max(1, len(bins) // 20)][::-1]:
        if fill[i] < capacity:
            loose += bins[i]
            bins[i] = None
    kept = [(x, f) for x, f in zip(bins, fill) if x is not None]
    loose.sort(key=lambda x: -sizes[x])
    return best_fit(loose, sizes, capacity, Bins([x for x, _ in kept], [f for _, f in kept]))


def evolve(
    sizes: list[int], capacity: int, seed: int, population: list[Bins], size: int, generations: int
) -> list[Bins]:
    """One island, until ``generations`` steps in a row find no better solution or none can be better."""
    rng = random.Random(seed)
    least = -(-sum(sizes) // capacity)
    falling = sorted(range(len(sizes)), key=lambda x: -sizes[x])
    if not population:
        population = [best_fit(falling, sizes, capacity)]
    while len(population) < size and len(population[0].bins) > least:
        noise = {x: sizes[x] * (1 + 0.15 * rng.random()) for x in falling}
        population.append(best_fit(sorted(falling, key=lambda x: -noise[x]), sizes, capacity))
    population.sort(key=lambda s: s.worth(capacity), reverse=True)
    idle = 0
    while idle < generations and len(population[0].bins) > least:
        idle += 1
        one, two = rng.sample(population, 2)
        child = crossover(one, two, sizes, capacity, rng, share=0.5)
        if child.worth(capacity) > population[0].worth(capacity):
            idle = 0
        if child.worth(capacity) > population[-1].worth(capacity):
            population[-1] = child
            population.sort(key=lambda s: s.worth(capacity), reverse=True)
    return population


def _problem_key(n: int):
    return F.pmod(F.xxhash64("uid"), F.lit(n)).cast("int")


def pack(
    pieces: DataFrame, capacity: int, *, islands: int = 2, epochs: int = 2, generations: int = 30, size: int = 4
) -> DataFrame:
    """Give each piece a sequence and its place there.

    ``pieces`` is a staged table as ``document_pieces`` makes it. Full pieces fill a sequence each.
    The rest is dealt by the hash of its number into problems of about PROBLEM pieces, so no source,
    length or document decides where work lands. Each problem evolves on several islands until they find
    nothing better; after an epoch each island's best solution migrates to the next island of its problem. The winners' bins
    that are not full enough to matter are dealt anew, at a fifth of the number of problems, and
    evolve once more together, which closes the few slack bins every problem is left with.
    """
    full = pieces.where(F.col("length") >= capacity).select(
        "uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    open_ = pieces.where(F.col("length") < capacity).select("uid", "length")
    count = open_.count()
    first = _round(open_, max(1, -(-count // PROBLEM)), capacity, islands, epochs, generations, size, "packed")
    slack = first.where(F.col("fill") < 0.98 * capacity).select("uid", "length")
    left = slack.count()
    again = _round(slack, max(1, -(-left // PROBLEM)), capacity, 1, 1, generations, size, "repacked")
    placed = first.where(F.col("fill") >= 0.98 * capacity).unionByName(again)
    places = placed.select("uid", "sequence_id", "offset").unionByName(full)
    return pieces.join(places, "uid").drop("uid")


def _round(
    open_: DataFrame, n: int, capacity: int, islands: int, epochs: int, generations: int, size: int, name: str
) -> DataFrame:
    """Evolve n problems; (uid, length, sequence_id, offset, fill), staged."""
    dealt = open_.withColumn("problem", _problem_key(n)).withColumn(
        "island", F.explode(F.array(*[F.lit(i) for i in range(islands)]))
    )
    state = "problem int, island int, uid long, length long, bin int, guest int"
    current = dealt.withColumns({"bin": F.lit(None).cast("int"), "guest": F.lit(None).cast("int")})

    def one_epoch(epoch: int):
        def island(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values("uid", kind="stable", ignore_index=True)
            sizes = frame["length"].tolist()
            population = []
            for column in ("bin", "guest"):
                if frame[column].notna().all():
                    population.append(_bins(frame[column].to_numpy(np.int64), sizes))
            seed = zlib.crc32(repr((int(frame["problem"][0]), int(frame["island"][0]), epoch)).encode())
            best = evolve(sizes, capacity, seed, population, size, generations)[0]
            where = np.zeros(len(sizes), np.int32)
            for i, items in enumerate(best.bins):
                where[items] = i
            return frame.assign(bin=where, guest=None)[["problem", "island", "uid", "length", "bin", "guest"]]

        return island

    for epoch in range(epochs):
        current = common.stage(current.groupBy("problem", "island").applyInPandas(one_epoch(epoch), state), name)
        if epoch + 1 < epochs and islands > 1:
            guests = current.select(
                "problem", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), "uid", F.col("bin").alias("guest")
            )
            current = current.drop("guest").join(guests, ["problem", "island", "uid"])
    base = 1 << 62 if name == "repacked" else 1 << 61

    def winner(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["island", "uid"], kind="stable")
        chosen = min((own for _, own in frame.groupby("island")), key=lambda own: own["bin"].max())
        chosen = chosen.sort_values(["bin", "uid"], kind="stable")
        by = chosen.groupby("bin")["length"]
        return chosen.assign(
            offset=by.cumsum() - chosen["length"], fill=by.transform("sum"),
            sequence_id=base + chosen["problem"].astype("int64") * (PROBLEM * 100) + chosen["bin"],
        )[["uid", "length", "sequence_id", "offset", "fill"]]

    return common.stage(
        current.groupBy("problem").applyInPandas(winner, "uid long, length long, sequence_id long, offset long, fill long"),
        name,
    )


def _bins(where: np.ndarray, sizes: list[int]) -> Bins:
    bins: list[list[int]] = [[] for _ in range(int(where.max()) + 1)]
    for item, b in enumerate(where.tolist()):
        bins[b].append(item)
    bins = [b for b in bins if b]
    return Bins(bins, [sum(sizes[x] for x in b) for b in bins])
