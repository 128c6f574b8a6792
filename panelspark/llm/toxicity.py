"""Toxicity of texts: a sparse linear classifier with counterfactual regularisation."""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import common
from panelspark.llm import words as W

#: Labelled documents the classifier is fitted on (a hash sample), and the distinct changes of features under
#: swapped terms, each with the number of sentences it stands for: the bounds of what the driver gets.
SAMPLE, CHANGES = 8_000, 32_000
#: log2 of the number of hashed features; the weights take 16 MB whatever the corpus.
BITS = 22
#: What a feature has to show in the sample: texts that hold it, and toxic ones beyond chance (see ``fit``).
LEAST, EVIDENCE = 3, 1.6
#: Entries of the sample that a sum of the fit takes at a time.
ENTRIES = 1 << 17
#: Beginnings of words, in bytes, that are features beside the words: stems of inflected forms.
STEMS = (4, 5, 6)
#: Groups whose mention alone must not move a score; terms of one tuple can stand for each other.
IDENTITIES = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("disabled", "blind", "deaf", "autistic"),
)
_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
_TERM = re.compile(r"\b(" + "|".join(t for group in IDENTITIES for t in group) + r")\b", re.IGNORECASE)
_OTHERS = {t: [o for o in group if o != t] for group in IDENTITIES for t in group}
_SEPARATORS = np.array([b < 48 or 58 <= b < 65 or 91 <= b < 97 or 123 <= b < 128 for b in range(256)])


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, feature) of every word and stem, segment by segment; repeats within a text stay in."""
    for part in W.words(*W.column_bytes(column), space=_SEPARATORS):
        if not len(part.start):
            continue
        size, ends = part.end - part.start, [part.end]
        for stem in STEMS:
            ends.append(np.where(size >= stem, part.start + stem, -1))
        rows, found = [], []
        for kind, end in enumerate(ends):
            use = end > 0
            h = W.span_hashes(part.data, part.start[use], end[use])
            # a stem of its own kind: the word "scum" and the stem "scum-" are two features
            found.append((W.mix(h + np.uint64(kind)) >> np.uint64(64 - BITS)).astype(np.int64))
            rows.append(part.row[use])
        yield np.concatenate(rows), np.concatenate(found)


def _sets(texts: list[str]) -> list[np.ndarray]:
    """The distinct features of each text."""
    keys = [row * (1 << BITS) + f for row, f in features(pa.array(texts, pa.string()))]
    keys = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    cut = np.searchsorted(keys, np.arange(len(texts) + 1) << BITS)
    return [(keys[a:b] & ((1 << BITS) - 1)).astype(np.int32) for a, b in zip(cut[:-1], cut[1:])]


def counterfactuals(text: str) -> list[tuple[str, str]]:
    """Sentences that name a group, each beside itself with every such term swapped for another of its kind."""
    out = []
    for match in _SENTENCE.finditer(text):
        sentence = match.group()
        names = {t.lower() for t in _TERM.findall(sentence)}
        if names:
            for shift in range(2):
                swap = lambda m: (o := _OTHERS[m.group().lower()])[(len(sentence) + shift) % len(o)]  # noqa: B023, E731
                out.append((sentence, _TERM.sub(swap, sentence)))
    return out


def _sparsity(n: int, evidence: float) -> float:
    """The L1 term for n texts; a feature whose pull is below half of it from the start is left out of the fit."""
    return float(0.9 * (1 + evidence * np.log10(n)) / n)


def _sums(at: np.ndarray, value: Callable[[slice], np.ndarray], size: int) -> np.ndarray:
    """``np.bincount(at, value, size)``, added in the same order, without arrays as long as ``at``."""
    out = np.zeros(size)
    for lo in range(0, len(at), ENTRIES):
        part = slice(lo, lo + ENTRIES)
        np.add.at(out, at[part], value(part))
    return out


@dataclass
class Classifier:
    """Non-zero weights by feature, and the bias."""

    feature: np.ndarray
    weight: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BITS, np.float32)
        out[self.feature] = self.weight
        return out


def fit(
    sets: list[np.ndarray], labels: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]] = (), *,
    times: np.ndarray | None = None, evidence: float = EVIDENCE, fairness: float = 5.0, least: int = LEAST, rounds: int = 120,
) -> Classifier:
    """Logistic loss + L1 + ``fairness`` * mean squared change of the log-odds under a swap.

    ``times``: how often each of the pairs occurs; once if not given.

    The L1 term lets a feature in that marks about 1 + ``evidence`` * log10(n) more toxic texts than
    chance would, so that chance finds stay out at every sample size. Accelerated proximal gradient steps; then the features found are refitted without the L1 shrinkage.
    Features of fewer than ``least`` texts are left out.
    """
    n = len(sets)
    if not n:
        return Classifier(np.zeros(0, np.int64), np.zeros(0), -2.0)
    sparsity = _sparsity(n, evidence)
    size = 1 << BITS
    total, toxic = np.zeros(size, np.int32), np.zeros(size, np.int32)
    for s, y in zip(sets, labels):
        np.add.at(total, s, 1)
        if y:
            np.add.at(toxic, s, 1)
    columns = np.flatnonzero(total >= least)
    pull = np.abs(toxic[columns] - labels.mean() * total[columns]) / n
    columns = columns[pull >= 0.5 * sparsity].astype(np.int32)
    del total, toxic, pull
    if not len(columns):
        columns = np.zeros(1, np.int32)

    def indexed(some: list[np.ndarray], kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, column) of the kept features, in narrow integers: the sample has millions of entries."""
        place = np.full(size, -1, np.int32)
        place[kept] = np.arange(len(kept), dtype=np.int32)
        hits = [a[a >= 0] for a in (place[s] for s in some)]
        row = np.repeat(np.arange(len(some), dtype=np.int32), [len(h) for h in hits])
        return row, np.concatenate([*hits, np.zeros(0, np.int32)])

    def solve(kept: np.ndarray, l1: float, l2: float, steps: int) -> tuple[np.ndarray, float]:
        row, col = indexed(sets, kept)
        d_row = d_col = d_sign = share = None
        if len(pairs):
            ra, ca = indexed([np.setdiff1d(a, b) for a, b in pairs], kept)
            rb, cb = indexed([np.setdiff1d(b, a) for a, b in pairs], kept)
            d_row, d_col = np.concatenate([ra, rb]), np.concatenate([ca, cb])
            d_sign = np.concatenate([np.ones(len(ra)), -np.ones(len(rb))])
            share = np.ones(len(pairs)) if times is None else np.asarray(times, float)
            share = share / share.sum()
        w, v, bias, t = np.zeros(len(kept)), np.zeros(len(kept)), float(np.log((labels.mean() + 0.01) / (1.01 - labels.mean()))), 1.0

        def gradient(v: np.ndarray, bias: float) -> tuple[float, np.ndarray, float]:
            z = _sums(row, lambda part: v[col[part]], n) + bias
            r = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / n
            loss = float(np.mean(np.logaddexp(0, z) - labels * z)) + 0.5 * l2 * float(v @ v)
            g = _sums(col, lambda part: r[row[part]], len(kept)) + l2 * v
            if d_row is not None:
                change = _sums(d_row, lambda part: d_sign[part] * v[d_col[part]], len(pairs))
                loss += fairness * float(share @ (change * change))
                push = share * change
                g = g + 2 * fairness * _sums(d_col, lambda part: d_sign[part] * push[d_row[part]], len(kept))
            return loss, g, float(r.sum())

        step = 8.0
        for _ in range(steps):
            loss, g, gb = gradient(v, bias)
            while True:
                new = v - step * g
                new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
                new_bias = bias - min(step, 4.0) * gb
                move = new - v
                after = gradient(new, new_bias)[0]
                if after <= loss + float(g @ move) + float(move @ move) / (2 * step) + 1e-10 or step < 1e-6:
                    break
                step /= 2
            t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
            v, w, bias, t = new + (t - 1) / t_new * (new - w), new, new_bias, t_new
        return w, bias

    w, bias = solve(columns, sparsity, 0.0, rounds // 2)
    # what the L1 term leaves at all; then the same features without its shrinkage
    kept = columns[np.abs(w) > 1e-3]
    if len(kept):
        w, bias = solve(kept, 0.0, 1e-3, rounds)
    else:
        w = np.zeros(0)
    return Classifier(kept.astype(np.int64), w, bias)


def _useful_sets(sample: DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
    """The features of each text of the sample without those that ``fit`` leaves out anyway, and its labels (0 or 1).

    In an order of the texts' own, so that sums do not depend on where the rows lay.
    """
    bad = (F.col("label") > 0).cast("long")
    n, toxic = sample.agg(F.count(F.lit(1)), F.sum(bad)).first()
    if not n:
        return [], np.zeros(0)
    counts = sample.select(bad.alias("toxic"), F.explode("features").alias("feature")).groupBy("feature")
    counts = counts.agg(F.count(F.lit(1)).alias("total"), F.sum("toxic").alias("toxic")).where(F.col("total") >= LEAST)
    pull = F.abs(F.col("toxic") - F.lit(toxic / n) * F.col("total")) / F.lit(float(n))
    columns = counts.where(pull >= 0.5 * _sparsity(n, EVIDENCE)).select("feature").toArrow().column(0).to_numpy()
    # without any, fit takes feature 0
    shared = sample.sparkSession.sparkContext.broadcast(columns if len(columns) else np.zeros(1, np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        useful = np.zeros(1 << BITS, bool)
        useful[shared.value] = True
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            feature, size = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
            hit = useful[feature]
            kept = np.concatenate([np.zeros(1, np.int64), np.cumsum(hit)])[np.cumsum([0, *size])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(size, pa.int32()), pa.ListArray.from_arrays(kept.astype(np.int32), feature[hit])],
                names=["doc_id", "copy", "label", "crc", "size", "features"],
            )

    got = sample.select("doc_id", "copy", "label", "crc", "features").mapInArrow(
        run, "doc_id long, copy long, label int, crc long, size int, features array<int>"
    ).toArrow()
    keys = [got[k].to_numpy() for k in ("copy", "doc_id", "label", "crc", "size")]
    lists = got["features"].combine_chunks()
    del got
    feature, ends = lists.flatten().to_numpy(), np.cumsum([0, *lists.value_lengths().to_numpy()])
    order = np.lexsort(keys)
    return [feature[ends[i] : ends[i + 1]] for i in order], (keys[2][order] > 0).astype(float)


def train(docs: DataFrame, labels: DataFrame, held_out, *, text: str = "text", doc_id: str = "doc_id", label: str = "toxic") -> Classifier:
    """Fit on a hash sample of at most SAMPLE labelled documents that aren't held out.

    A document labelled more than once is toxic if one label says so; of rows that repeat a doc_id and its
    text one is used. The counterfactual sentences of all sampled documents count: equal changes of features
    are summed, so they take no place of a document. Features are counted where they lie, and only those that
    ``fit`` would use leave the executors, as Arrow; the sample's ids, at most SAMPLE of them, and the features
    to keep are broadcast.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")
    )
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("text is not null")

    swap = pa.list_(pa.struct([("gone", pa.binary()), ("come", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = part.column(1).to_pylist()
                swaps = [(i, *p) for i, t in enumerate(texts) for p in counterfactuals(t)]
                changes: list[list[dict]] = [[] for _ in texts]
                for (i, *_), a, b in zip(swaps, _sets([p[1] for p in swaps]), _sets([p[2] for p in swaps])):
                    changes[i].append({"gone": np.setdiff1d(a, b).tobytes(), "come": np.setdiff1d(b, a).tobytes()})
                sets = _sets(texts)
                ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array([zlib.crc32(t.encode()) for t in texts], pa.int64()), part.column(2),
                        pa.array([zlib.crc32(s) for s in sets], pa.int64()),
                        pa.ListArray.from_arrays(ends, np.concatenate([*sets, np.zeros(0, np.int32)])), pa.array(changes, swap),
                    ],
                    names=["doc_id", "copy", "label", "crc", "features", "changes"],
                )

    found = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label").mapInArrow(
        run, "doc_id long, copy long, label int, crc long, features array<int>, changes array<struct<gone: binary, come: binary>>"
    )
    found = common.stage(found.dropDuplicates(["doc_id", "copy"]), "sample")
    sample = found
    if found.count() > SAMPLE:  # an id has many texts
        first = found.select("doc_id", "copy").orderBy(F.xxhash64("doc_id", "copy"), "doc_id", "copy").limit(SAMPLE)
        sample = common.stage(found.join(F.broadcast(first), ["doc_id", "copy"]), "sample")
    sets, marks = _useful_sets(sample)
    read = lambda raw: np.frombuffer(bytes(raw), np.int32)
    moved = found.select(F.explode("changes").alias("c")).groupBy("c.gone", "c.come").agg(F.count(F.lit(1)).alias("n"))
    moved = moved.orderBy(F.xxhash64("gone", "come"), "gone", "come").limit(CHANGES).collect()
    pairs, times = [(read(r.gone), read(r.come)) for r in moved], np.array([r.n for r in moved], float)
    return fit(sets, marks, pairs, times=times)


def _probabilities(model: tuple, batches: Iterator[pa.Array]) -> Iterator[np.ndarray]:
    """Probability of every text of each batch."""
    own = Classifier(*model)
    dense = own.dense()
    used = dense != 0
    for batch in batches:
        z = np.full(len(batch), own.bias)
        keys = []
        for row, f in features(batch):
            hit = np.flatnonzero(used[f])
            keys.append((row[hit] << BITS) | f[hit])
        if keys:
            keys = np.unique(np.concatenate(keys))
            z += np.bincount(keys >> BITS, dense[keys & ((1 << BITS) - 1)], len(batch))
        yield 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _share(docs: DataFrame, classifier: Classifier):
    return docs.sparkSession.sparkContext.broadcast((classifier.feature, classifier.weight, classifier.bias))


def score(
    docs: DataFrame, classifier: Classifier, *, text: str = "text", threshold: float = 0.3, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` and score (0 to 1) and predicted (1 from ``threshold`` on) of every whole text.

    A feature counts once per text, however long it is. NULL and empty texts get the bias alone.
    """
    shared = _share(docs, classifier)
    rows = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches, again = itertools.tee(batches)
        texts = (batch.column(batch.num_columns - 1) for batch in again)
        for batch, p in zip(batches, _probabilities(shared.value, texts)):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                names=[*batch.schema.names[:-1], "score", "predicted"],
            )

    return rows.mapInArrow(run, f"{shape}, score double, predicted int")


def accepted(docs: DataFrame, classifier: Classifier, *, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, with all columns.

    Only texts go to Python and only scores come back. NULL and empty texts get the bias alone; rows that
    repeat are judged alike.
    """
    shared = _share(docs, classifier)

    @F.arrow_udf("double")
    def p(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from map(pa.array, _probabilities(shared.value, batches))

    return docs.where(p(F.col(text).cast("string")) < threshold)
