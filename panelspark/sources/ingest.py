"""Fetching many keys in parallel, coverage, and snapshots that replace a cache."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.schema import SYMBOL
from panelspark.session import stage

MAX_RETRIES = 3  # fixed values: attempts, first pause in seconds, age limit of a snapshot
RETRY_DELAY = 2.0
SNAPSHOT_DAYS = 1

Fetch = Callable[[str], "pd.DataFrame | Iterable[pd.DataFrame]"]
Parse = Callable[[bytes], "pd.DataFrame | Iterable[pd.DataFrame]"]


def _attempts(
    name: str, frames: Callable[[], "pd.DataFrame | Iterable[pd.DataFrame]"], key: str, columns: list[str], retries: int, delay: float
) -> Iterator[pd.DataFrame]:
    """The frames of one key, then, if it still fails in the last attempt, a row with only the error.

    A later attempt goes on after the frames that were handed on, so none comes twice.
    """
    handed = 0
    for attempt in range(1, retries + 1):
        try:
            got = frames()
            for i, piece in enumerate([got] if isinstance(got, pd.DataFrame) else got):
                if i >= handed:
                    piece = piece[columns].copy()
                    piece.insert(0, key, name)
                    piece["error"] = None
                    yield piece
                    handed = i + 1
            return
        except Exception as exc:  # noqa: BLE001
            error = f"{type(exc).__name__}: {exc}"
            if attempt < retries:
                time.sleep(delay * attempt)
    yield pd.DataFrame({key: [name], **{c: [None] for c in columns}, "error": [error]})


def _with_error(key: str, schema: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField(key, T.StringType()), *schema.fields, T.StructField("error", T.StringType())]
    )


def ingest_by_key(
    manifest: DataFrame,
    fetch: Fetch,
    schema: T.StructType,
    key: str = SYMBOL,
    retries: int = MAX_RETRIES,
    delay: float = RETRY_DELAY,
    partitions: int | None = None,
) -> DataFrame:
    """Rows of ``fetch(key)`` for every key, with ``key`` and ``error``.

    Keys are spread over tasks. ``fetch`` returns one frame or yields frames piece by piece, the same ones
    in every attempt, so that a key of any size streams through its task. Each attempt is followed by a
    longer pause; a key that still fails after ``retries`` of them gives one row that holds only the
    error, after the rows that came before it failed half-way. No failing key ends the job.
    """
    columns = [f.name for f in schema.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch[key]:
                yield from _attempts(name, lambda name=name: fetch(name), key, columns, retries, delay)

    keys = manifest.select(F.col(key).cast("string").alias(key)).distinct()
    n = partitions or manifest.sparkSession.sparkContext.defaultParallelism
    return keys.repartition(n, key).mapInPandas(run, _with_error(key, schema))


def ingest_files(
    manifest: DataFrame, path: str, parse: Parse, schema: T.StructType, key: str = SYMBOL, pattern: str = "*.csv"
) -> DataFrame:
    """The same from files below ``path``, in folders ``<key>=<value>``, in any store that Spark reads.

    Every file of a wanted key is read once, by the task that parses it; ``parse(content)`` returns a frame or
    yields frames. A file that can't be parsed gives an error row, a key without a file another one. A
    file is a value, so it has to be below 2 GB; keys of any size come as several files.
    """
    columns = [f.name for f in schema.fields]
    spark = manifest.sparkSession
    keys = manifest.select(F.col(key).cast("string").alias(key)).distinct()
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select(
        F.col(key).cast("string").alias(key), "content"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch[key], batch["content"]):
                yield from _attempts(name, lambda content=content: parse(content), key, columns, 1, 0.0)

    known = files.select(key).distinct()
    absent = keys.join(known, key, "left_anti").select(
        key, *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], F.lit("FileNotFoundError: no file").alias("error")
    )
    # contents stay where they are read as long as the wanted keys are small enough to be sent to them
    wanted = files.join(keys, key, "left_semi")
    return wanted.mapInPandas(run, _with_error(key, schema)).unionByName(absent)


def fetched(rows: DataFrame, key: str = SYMBOL) -> DataFrame:
    """The rows of keys that arrived whole; raises if none did. Rows are stored first, so nothing is fetched twice."""
    rows = stage(rows)
    failed = rows.where(F.col("error").isNotNull()).select(key).distinct()
    good = rows.where(F.col("error").isNull()).join(failed, key, "left_anti").drop("error")
    if good.isEmpty():
        raise RuntimeError("no key could be fetched")
    return good


def ingest_coverage(manifest: DataFrame, arrived: DataFrame, key: str = SYMBOL) -> DataFrame:
    """Requested keys that did not arrive."""
    return manifest.select(key).distinct().join(arrived.select(key), key, "left_anti")


def snapshot(df: DataFrame, path: str, as_of: dt.date) -> None:
    """Store a pull under its load date; other dates stay."""
    df.write.mode("overwrite").parquet(f"{path}/load_date={as_of.isoformat()}")


def latest_snapshot(
    spark: SparkSession, path: str, today: dt.date, max_age_days: int = SNAPSHOT_DAYS
) -> DataFrame | None:
    """The newest stored pull younger than ``max_age_days``, or None.

    Only the partition values are looked at to find it, only its files are read.
    """
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    oldest = today - dt.timedelta(days=max_age_days - 1)
    fresh = F.col("load_date").between(F.lit(oldest), F.lit(today))
    newest = stored.where(fresh).agg(F.max("load_date")).first()[0]
    if newest is None:
        return None
    return stored.where(F.col("load_date") == F.lit(newest)).drop("load_date")


def ingest_all(
    sources: dict[str, Callable[[], DataFrame | None]], mandatory: tuple[str, ...] = ("prices",)
) -> dict[str, DataFrame | None]:
    """Run the named sources; a failing optional one is left out, a mandatory one raises."""
    tables: dict[str, DataFrame | None] = {}
    for name, load in sources.items():
        try:
            tables[name] = load()
        except Exception:
            if name in mandatory:
                raise
            tables[name] = None
        if tables[name] is None and name in mandatory:
            raise RuntimeError(f"{name} could not be loaded")
    return tables
