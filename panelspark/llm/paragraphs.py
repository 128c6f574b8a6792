"""Passages that repeat across documents: paragraph pieces, MinHash bands, exact verification, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm import common, shingles
from panelspark.llm import words as W
from panelspark.session import release

#: A piece ends at a word whose hash is the least within so many words on either side.
REACH = 3
#: Words of a run of repeated pieces, and of a near-duplicate paragraph, that make a passage.
RUN, PARAGRAPH = 24, 20
MAX_BANDS = 20
#: Text worked on at a time: words take many times their bytes, and a pipeline's earlier stages hold memory too.
SLICE = 1 << 19
SPANS = "doc_id long, start long, stop long, words long, first_doc long, component_id long, kind string"


def tune_bands(threshold: float, recall: float = 0.9999, most: int = MAX_BANDS) -> tuple[int, int]:
    """(bands, rows) with the most rows a band that still find a pair at the threshold with the recall.

    Two signatures agree in a band of r rows with probability s**r; b bands find the pair with
    1 - (1 - s**r)**b. More rows mean fewer chance collisions, so the largest r that needs at most
    ``most`` bands is taken, and the least b for it.
    """
    best = (1, 1)
    for rows in range(1, 33):
        missed = 1 - threshold**rows
        bands = int(np.ceil(np.log(1 - recall) / np.log(missed))) if missed > 0 else 1
        if bands <= most:
            best = (max(1, bands), rows)
    return best


def _words(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, start, end, hash, paragraph) of all words of a slice of rows; byte positions within the row's text."""
    data, offsets = W.column_bytes(column)
    rows, starts, ends, hashes = [], [], [], []
    at = 0
    for part in W.words(data, offsets):
        rows.append(part.row)
        starts.append(part.start + at)
        ends.append(part.end + at)
        hashes.append(part.hashes())
        at += len(part.data)
    if not sum(map(len, rows)):
        return
    row, start, end = np.concatenate(rows), np.concatenate(starts), np.concatenate(ends)
    breaks = np.concatenate([[0], np.cumsum(data == 10)])[start]
    yield row, start - offsets[row], end - offsets[row], np.concatenate(hashes), breaks


def _cuts(row: np.ndarray, breaks: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word of each paragraph, first word of each piece); pieces depend on nearby words only."""
    n = len(h)
    paragraph = np.ones(n, bool)
    paragraph[1:] = (row[1:] != row[:-1]) | (breaks[1:] != breaks[:-1])
    least = np.ones(n, bool)
    for d in range(1, REACH + 1):
        least[d:] &= h[d:] < h[:-d]
        least[:-d] &= h[:-d] <= h[d:]
    return np.flatnonzero(paragraph), np.flatnonzero(paragraph | least)


def pieces(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(doc_id, copy, piece, paragraph, hash, start, stop, words) of every piece of every paragraph (a line).

    ``copy`` tells apart the texts of rows that repeat a doc_id.
    """
    shape = "doc_id long, copy int, piece int, paragraph int, hash long, start int, stop int, words int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, part in shingles.slices(batch.column(1), SLICE):
                ids = np.asarray(batch.column(0).slice(lo, len(part)))
                for row, start, end, h, breaks in _words(part):
                    lines, first = _cuts(row, breaks, h)
                    last = np.append(first[1:], len(h))
                    total = np.zeros(len(h) + 1, np.uint64)
                    np.cumsum(h * _powers(len(h)), out=total[1:])
                    key = W.mix((total[last] - total[first]) * _inverses(first) + (last - first).astype(np.uint64))
                    owner = row[first]
                    line = np.searchsorted(lines, first, "right")
                    begin = np.searchsorted(owner, owner)  # first piece of the same row
                    opening = first[begin]
                    closing = last[np.searchsorted(owner, owner, "right") - 1]
                    whole = W.mix((total[closing] - total[opening]) * _inverses(opening) + (closing - opening).astype(np.uint64))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[owner]), pa.array((whole >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                            pa.array((np.arange(len(first)) - begin).astype(np.int32)),
                            pa.array((line - line[begin]).astype(np.int32)), pa.array(key.view(np.int64)),
                            pa.array(start[first].astype(np.int32)), pa.array(end[last - 1].astype(np.int32)),
                            pa.array((last - first).astype(np.int32)),
                        ],
                        names=["doc_id", "copy", "piece", "paragraph", "hash", "start", "stop", "words"],
                    )

    return _rows(docs, text, doc_id).mapInArrow(run, shape)


_STEP = 0xA0761D6478BD642F
_powers_of: dict[str, np.ndarray] = {}


def _powers(n: int) -> np.ndarray:
    if len(_powers_of.get("up", ())) < n:
        size = max(n, 1 << 17)
        for name, base in (("up", _STEP), ("down", pow(_STEP, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers_of[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers_of["up"][:n]


def _inverses(at: np.ndarray) -> np.ndarray:
    return _powers_of["down"][at]


def _rows(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )


def repeated_passages(
    docs: DataFrame, threshold: float = 0.8, *, text: str = "text", doc_id: str = "doc_id", run: int = RUN,
    paragraph: int = PARAGRAPH,
) -> DataFrame:
    """Spans of passages that an earlier document (one of a smaller doc_id) has as well; a row per span.

    Columns: doc_id, start and stop (bytes of the text), words, first_doc (the document that keeps most of
    its pieces), component_id (the least document its cluster of near-duplicate paragraphs reaches, or
    first_doc), kind ("run" or "paragraph").

    Paragraphs are lines. First, lines are cut into pieces of about seven words at places that only the
    words around decide, so a passage inside a longer line gives the same pieces everywhere; pieces this
    short are similar at the threshold only if equal. Stretches of consecutive pieces that just reach ``run``
    words count if one earlier document has the same words in the same order; those that overlap make a
    run. Second, every line of ``paragraph`` words that shares a piece
    with another document is signed by MinHash, equal lines as one class; bands tuned for recall at the
    threshold bring lines together, their shingle sets are compared exactly, and the components decide:
    a line goes if its cluster holds one of a smaller doc_id, unless all its pieces are in earlier ones and
    runs hold the threshold's share of it as it stands. Lines are expected to have a piece in common:
    a line of 20 words and five-word shingles can't reach 0.8 with an inner word changed.

    Texts that are NULL, empty or shorter give no spans; repetition inside one document, and rows that
    repeat a doc_id, are left alone; rows without doc_id are skipped.
    """
    every = pieces(docs, text, doc_id)
    shared = every.groupBy("hash").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("_last")).where("first_doc < _last")
    found = common.stage(every.join(shared.select("hash", "first_doc"), "hash"), "shared-pieces")
    parts = common.stage(stretches(found, run), "stretches")
    earliest = parts.groupBy("hash").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("_last")).where("first_doc < _last")
    held = parts.join(earliest.select("hash", "first_doc"), "hash").where("doc_id > first_doc")
    order = Window.partitionBy("doc_id", "copy").orderBy("first", "last")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    held = held.withColumn("opens", F.when(F.col("first") <= before, 0).otherwise(1))
    runs = (
        held.withColumn("island", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc_id", "copy", "island")
        .agg(
            F.min("start").cast("long").alias("start"), F.max("stop").cast("long").alias("stop"),
            (F.max("until") - F.min("since")).alias("words"), F.mode("first_doc", True).alias("first_doc"),
        )
        .select("doc_id", "start", "stop", "words", "first_doc", F.col("first_doc").alias("component_id"), F.lit("run").alias("kind"))
    )
    runs = common.stage(runs, "runs")
    release(parts)
    near = near_paragraphs(docs, found, runs, threshold, paragraph, text, doc_id)
    return runs.unionByName(near)


def stretches(shared_pieces: DataFrame, run: int) -> DataFrame:
    """Stretches of consecutive shared pieces that just reach ``run`` words, forwards from or backwards to a piece.

    Columns: hash (of the pieces in order), doc_id, copy, first and last (pieces), start and stop (bytes),
    since and until (words of the document's shared pieces before the stretch, and to its end). Both
    directions together cover every piece of any ``run`` words that two documents have in common.
    """
    shape = "hash long, doc_id long, copy int, first int, last int, start int, stop int, since long, until long"
    names = ["doc_id", "copy", "piece", "hash", "start", "stop", "words"]

    def found(table: pa.Table) -> pa.RecordBatch | None:
        columns = [table.column(n).to_numpy() for n in names]
        doc, copy, piece = columns[:3]
        once = np.ones(len(doc), bool)  # rows that repeat lie next to each other
        once[1:] = (doc[1:] != doc[:-1]) | (copy[1:] != copy[:-1]) | (piece[1:] != piece[:-1])
        doc, copy, piece, key, start, stop, size = (c[once] for c in columns)
        n = len(doc)
        fresh = np.ones(n, bool)  # not the piece after the one before
        fresh[1:] = (doc[1:] != doc[:-1]) | (copy[1:] != copy[:-1]) | (piece[1:] != piece[:-1] + 1)
        island = np.cumsum(fresh)
        ends = np.cumsum(size.astype(np.int64))
        begins = ends - size
        at = np.arange(n)
        last = np.searchsorted(ends, begins + run)
        first = np.searchsorted(begins, ends - run, "right") - 1
        a = np.concatenate([at, first])
        b = np.concatenate([last, at])
        inside = (a >= 0) & (b < n)
        a, b = a[inside], b[inside]
        inside = island[a] == island[b]
        pairs = np.unique(a[inside] * np.int64(n) + b[inside])
        if not len(pairs):
            return None
        a, b = pairs // n, pairs % n
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(key.view(np.uint64) * _powers(n), out=total[1:])
        own = W.mix((total[b + 1] - total[a]) * _inverses(a) + (b - a).astype(np.uint64)).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (own, doc[a], copy[a], piece[a], piece[b], start[a], stop[b], begins[a], ends[b])],
            names=["hash", "doc_id", "copy", "first", "last", "start", "stop", "since", "until"],
        )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # a document that goes on in the next batch waits for it
            doc = batch.column(0).to_numpy()
            cut = int(np.searchsorted(doc, doc[-1]))
            if cut or (kept and kept[-1].column(0)[-1].as_py() != doc[0]):
                table = pa.Table.from_batches([*kept, batch.slice(0, cut)])
                kept = []
                if (out := found(table)) is not None:
                    yield out
            kept.append(batch.slice(cut))
        if kept and (out := found(pa.Table.from_batches(kept))) is not None:
            yield out

    own = shared_pieces.select(*names)
    return own.repartition("doc_id").sortWithinPartitions("doc_id", "copy", "piece").mapInArrow(walk, shape)


def near_paragraphs(
    docs: DataFrame, shared_pieces: DataFrame, runs: DataFrame, threshold: float, least: int, text: str, doc_id: str
) -> DataFrame:
    """Spans of lines whose cluster of similar lines holds one of an earlier document."""
    bands, height = tune_bands(threshold)
    # of each line its pieces that earlier documents hold; a row that repeats an id counts once
    held = shared_pieces.groupBy("doc_id", "paragraph").agg(
        F.count_distinct(F.when(F.col("first_doc") < F.col("doc_id"), F.col("piece"))).alias("later")
    )
    lines = held.groupBy("doc_id").agg(F.collect_list("paragraph").alias("lines"), F.collect_list("later").alias("later"))
    cut = runs.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("runs"))
    lines = lines.join(cut, "doc_id", "left").select(
        "doc_id", "lines", "later", F.coalesce("runs.start", F.array().cast("array<long>")).alias("since"),
        F.coalesce("runs.stop", F.array().cast("array<long>")).alias("until"),
    )
    shape = "node long, doc_id long, start long, stop long, words long, key long, in_run boolean, set binary, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = shingles.MinHash(bands * height, seed=3)
        signed: set[int] = set()
        for batch in batches:
            for lo, part in shingles.slices(batch.column(1), SLICE):
                ids = batch.column(0).slice(lo, len(part)).to_pylist()
                wanted = [
                    dict(zip(a, b))
                    for a, b in zip(*(batch.column(c).slice(lo, len(part)).to_pylist() for c in (2, 3)))
                ]
                cuts_of = [
                    tuple(np.array(x, np.int64) for x in ab)
                    for ab in zip(*(batch.column(c).slice(lo, len(part)).to_pylist() for c in (4, 5)))
                ]
                rows, some, place = [], [], []
                for row, start, end, h, breaks in _words(part):
                    first, cuts = _cuts(row, breaks, h)
                    inside = np.diff(np.searchsorted(cuts, np.append(first, len(h))))
                    last = np.append(first[1:], len(h))
                    owner = row[first]
                    number = np.arange(len(first)) - np.searchsorted(owner, owner)
                    for i in np.flatnonzero(last - first >= least).tolist():
                        o = int(owner[i])
                        if int(number[i]) in wanted[o]:
                            shingle = np.unique(shingles.shingle_hashes(h[first[i] : last[i]]))
                            same = int.from_bytes(shingles.digest(shingle)[:8], "little", signed=True)
                            # a task signs a line once, however often it occurs
                            place.append(-1 if same in signed else len(some))
                            if same not in signed:
                                signed.add(same)
                                some.append(shingle)
                            a, b = int(start[first[i]]), int(end[last[i] - 1])
                            since, until = cuts_of[o]
                            both = np.maximum(np.minimum(until, b) - np.maximum(since, a), 0).sum()
                            in_run = wanted[o][int(number[i])] >= inside[i] and both >= threshold * (b - a)
                            rows.append((ids[o], a, b, int(last[i] - first[i]), int(number[i]), same, in_run))
                if not rows:
                    continue
                key = np.zeros((0, bands), np.uint64)
                if some:
                    band = family.signatures(some).reshape(len(some), bands, height).astype(np.uint64)
                    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), band.shape[:2]).copy()
                    for i in range(height):
                        key = W.mix(key * np.uint64(0x100000001B3) + band[:, :, i])
                doc, start_, stop_, words_, number_, same_, in_run_ = (np.array(c, np.int64) for c in zip(*rows))
                node = W.mix(W.mix(doc.view(np.uint64)) + number_.view(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(c) for c in (node, doc, start_, stop_, words_, same_, in_run_.astype(bool))),
                        pa.array([some[j].tobytes() if j >= 0 else None for j in place], pa.binary()),
                        pa.array([key[j].view(np.int64) if j >= 0 else None for j in place], pa.list_(pa.int64())),
                    ],
                    names=["node", "doc_id", "start", "stop", "words", "key", "in_run", "set", "bands"],
                )

    # the same join at every size: texts are exchanged once, and no list of ids has to fit a task
    texts = _rows(docs, text, doc_id).join(lines.hint("merge"), "doc_id")
    signed = common.stage(texts.select("doc_id", "text", "lines", "later", "since", "until").mapInArrow(run, shape), "paragraphs")
    release(shared_pieces)  # nothing below reads it
    # equal lines are one class; a hot line costs one row per task in these exchanges
    classes = signed.groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.when(F.col("set").isNotNull(), F.struct("doc_id", "node")))["node"].alias("node"),
        F.count(F.lit(1)).alias("weight"),
    )
    classes = common.stage(classes.select("key", "weight", "node", "doc_id"), "paragraph-classes")
    once = signed.where("set is not null").select("key", "node", "set", "bands")
    spread = once.join(classes.select("key", "node"), ["key", "node"]).select("node", F.explode("bands").alias("band"))
    meets = spread.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most")
    edges = spread.join(meets.select("band", "least"), "band").where("node > least").select(
        F.col("node").alias("a"), F.col("least").alias("b")
    ).distinct()
    groups = common.components(edges).withColumnRenamed("component", "grp")
    items = once.join(classes.select("key", "node", "weight"), ["key", "node"]).join(groups, "node").select("grp", "node", "weight", "set")
    linked = common.stage(shingles.verified(items, items.select("grp", "node"), threshold), "verified")
    member = common.components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    cluster = (
        classes.join(member, "node", "left")
        .select("key", "doc_id", F.coalesce("component", "node").alias("component"))
    )
    first = cluster.groupBy("component").agg(F.min("doc_id").alias("first_doc"))
    keep = cluster.select("key", "component").join(first, "component").select("key", "first_doc")
    return (
        signed.where("not in_run").select("doc_id", "start", "stop", "words", "key").join(keep, "key").where("doc_id > first_doc")
        .select(
            "doc_id", "start", "stop", "words", "first_doc", F.col("first_doc").alias("component_id"),
            F.lit("paragraph").alias("kind"),
        )
    )


def without_passages(docs: DataFrame, spans: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with the spans cut out of their texts, all columns and rows kept.

    A text that is cut loses the spans and the white space before each; others are unchanged, as are rows
    without doc_id.
    """
    doc, cuts = common.fresh("doc", docs.columns), common.fresh("cuts", docs.columns)
    cut = spans.groupBy(F.col("doc_id").alias(doc)).agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias(cuts)
    )
    joined = docs.join(cut.hint("merge"), F.col(doc_id).cast("long") == F.col(doc), "left").drop(doc)
    names = docs.columns
    inner = [f.name for f in joined.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = inner.index(text)
            cuts = batch.column(len(inner) - 1)
            if cuts.null_count == len(cuts):
                yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=names)
                continue
            out = []
            for value, spans_ in zip(batch.column(at).to_pylist(), cuts.to_pylist()):
                if value is not None and spans_:
                    raw, kept, place = value.encode(), [], 0
                    for s in spans_:
                        kept.append(raw[place : max(place, s["start"])].rstrip() if s["start"] > place else b"")
                        place = max(place, s["stop"])
                    value = (b"".join(kept) + raw[place:]).decode().lstrip()
                out.append(value)
            columns = [*batch.columns[:-1]]
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return joined.mapInArrow(run, shape)
