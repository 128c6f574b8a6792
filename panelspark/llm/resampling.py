"""Target-distribution importance resampling: documents drawn by hashed n-gram likelihood ratios.

A batch's texts are joined with a separator between them, one regex pass finds all words, a binary search
over the documents' offsets tells whose they are and masks n-grams across two documents; bincount does
the rest. CRC-32 of a run of words is put together from those of its words.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm import common
from panelspark.llm import words as W
from panelspark.llm.shingles import slices

BUCKETS = 10_000
#: Longest run of words that is a feature.
GRAMS = 3
#: Documents with fewer words are never drawn.
LEAST_WORDS = 20
#: A byte between two texts; no word holds it.
SEPARATOR = b"\n"
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_INSIDE = np.array([bool(_WORD.match(bytes([b]))) for b in range(256)])
#: Words longer than this take their CRC byte by byte from zlib.
TABLED = 48
#: Reversed polynomial of CRC-32 (fixed value).
POLYNOMIAL = 0xEDB88320
_tables: dict[str, np.ndarray] = {}


def _crc_table() -> np.ndarray:
    """The CRC register after one zero byte, for each low byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table.astype(np.uint32)


def _shift_tables() -> np.ndarray:
    """[n, k, b]: byte b at place k of a register, moved on by n zero bytes; linear, so bytes are combined by xor."""
    if "shift" not in _tables:
        step = _crc_table()
        shift = np.zeros((TABLED + 2, 4, 256), np.uint32)
        for k in range(4):
            shift[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for n in range(1, len(shift)):
            shift[n] = step[shift[n - 1] & 0xFF] ^ (shift[n - 1] >> 8)
        _tables["shift"] = shift.reshape(-1)
    return _tables["shift"]


def _moved(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """CRCs moved on by ``by`` bytes each: what they add to the CRC of a longer text."""
    table, at = _shift_tables(), by.astype(np.int64) * 1024
    out = table[at + (crc & 0xFF)]
    for k in range(1, 4):
        out ^= table[at + 256 * k + ((crc >> np.uint32(8 * k)) & 0xFF)]
    return out


def ngram_buckets(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of every n-gram, n after n; rows without words give none. NULL texts are empty."""
    data, offsets = W.column_bytes(texts)
    raw = data.tobytes()
    texts = [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    joined = SEPARATOR.join([b"", *texts, b""]).lower()
    found = _WORD.findall(joined)
    if not found:
        return
    # words begin and end where the kind of byte changes; before each text stands a separator
    edges = np.flatnonzero(np.diff(_INSIDE[np.frombuffer(joined, np.uint8)])) + 1
    start, end = edges[::2], edges[1::2]
    crc = np.fromiter(map(zlib.crc32, found), np.uint32, len(found))
    row = np.searchsorted(offsets[:-1] + np.arange(1, len(offsets)), start, "right") - 1
    length = end - start
    short = length <= TABLED
    spaced = _moved(np.full(len(crc), zlib.crc32(b" "), np.uint32), np.where(short, length, 0)) ^ crc
    long = np.flatnonzero(~short)
    run = crc
    yield row, run % BUCKETS
    for n in range(2, GRAMS + 1):
        if len(run) < 2:
            return
        before, run = run, _moved(run[:-1], np.where(short, length + 1, 0)[n - 1 :]) ^ spaced[n - 1 :]
        for i in long[long >= n - 1].tolist():  # the word that ends the run is too long for the tables
            run[i - n + 1] = zlib.crc32(found[i], zlib.crc32(b" ", int(before[i - n + 1])))
        inside = row[: len(run)] == row[n - 1 :]
        yield row[: len(run)][inside], (run % BUCKETS)[inside]


def bucket_counts(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """(bucket, n) over all features of all texts: every task adds up its own, then one small exchange."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, part in slices(batch.column(0)):
                for _, bucket in ngram_buckets(part):
                    total += np.bincount(bucket, minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    found = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame) -> list[int]:
    """The gain of every bucket; the driver gets BUCKETS numbers, however large the tables are."""
    source = source.withColumnRenamed("n", "s")
    target = target.withColumnRenamed("n", "t")
    every = source.sparkSession.range(BUCKETS).select(F.col("id").alias("bucket"))
    both = common.stage(every.join(source, "bucket", "left").join(target, "bucket", "left").fillna(0), "buckets")
    total = both.agg(F.sum("s").alias("S"), F.sum("t").alias("T")).first()
    ratio = (F.col("t") + 1.0) * float(total["S"] + BUCKETS) / ((F.col("s") + 1.0) * float(total["T"] + BUCKETS))
    rows = both.select("bucket", F.floor(1000.0 * F.log(ratio)).alias("gain")).collect()
    out = [0] * BUCKETS
    for r in rows:
        out[r["bucket"]] = r["gain"]
    return out


def weigh(docs: DataFrame, gain: list[int], *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row, where the rows lie."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = np.array(shared.value, np.int64)
        for batch in batches:
            n, sums = np.zeros((GRAMS, batch.num_rows), np.int64), np.zeros(batch.num_rows, np.int64)
            for first, part in slices(batch.column(1)):
                rows = slice(first, first + len(part))
                for k, (row, bucket) in enumerate(ngram_buckets(part)):
                    n[k, rows] += np.bincount(row, minlength=len(part))
                    # sums of integers below 2**53 are exact in doubles
                    sums[rows] += np.bincount(row, value[bucket], len(part)).astype(np.int64)
            columns = [batch.column(0), pa.array(n[0]), pa.array(n.sum(axis=0)), pa.array(sums)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    kept = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return kept.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """``rows`` with their place from 1 in ``order``: one range exchange, tasks number their own range.

    ``rows`` has to be a staged table, for it is sampled before it is dealt. Which of two rows that
    are equal in ``order`` comes first is undetermined.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = common.fresh("_at", rows.columns)
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt = common.stage(dealt.withColumn(own, F.monotonically_increasing_id()), "ranked")
    part, place = F.shiftright(own, 33), F.col(own).bitwiseAND(2**33 - 1)
    sizes = dealt.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # a row per task of the exchange above
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    joined = dealt.join(F.broadcast(before), part == F.col("_part"))
    return joined.withColumn(name, F.col("_before") + place + 1).drop("_part", "_before", own)


def resample(
    docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    percent: int = 5, seed: int = 42,
) -> DataFrame:
    """Every row of ``docs``: doc_id, n_features, weight, score, rank (NULL where it isn't drawn).

    Of the N rows with at least LEAST_WORDS words, floor(percent * N / 100) are drawn without
    replacement, by the largest weight plus Gumbel noise of ``seed`` and the id; ties go to the smaller id,
    a NULL id first (its noise is that of an empty id). NULL and empty texts have no features and weight 0. Repeated
    rows count and are drawn as often as they stand there; other columns are ignored. An empty target
    makes gains of s alone; an empty ``docs`` gives an empty result. Texts are read twice where they lie and
    never exchanged; the driver gets 10,000 gains and N.
    """
    gain = gains(bucket_counts(docs, text=text), bucket_counts(target, text=target_text))
    weighed = weigh(docs, gain, doc_id=doc_id, text=text)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weighed.select(
        "doc_id", "n_features", "weight", (F.col("weight") + noise).alias("score"),
        (F.col("n_words") >= LEAST_WORDS).alias("eligible"),
    )
    scored = common.stage(scored, "scored")
    n = scored.where("eligible").count()
    order = [F.desc("eligible"), F.desc("score"), F.asc("doc_id")]
    placed = ranked(scored, order)
    drawn = F.when(F.col("eligible") & (F.col("rank") <= percent * n // 100), F.col("rank"))
    return placed.select("doc_id", "n_features", "weight", "score", drawn.alias("rank"))
