"""Reading wide CSV panels, optional indicator files and Parquet outputs of earlier stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.numeric import finite
from panelspark.operators.shape import from_wide
from panelspark.schema import PANEL, PRICE, SYMBOL, TS


def _wide(spark: SparkSession, path: str, panel: str) -> DataFrame:
    """First column is the date or time, every other column one series.

    Stamps are dates, unless one of them has a time of day: then all are timestamps without zone.
    """
    raw = spark.read.option("header", True).csv(path)
    index, *names = raw.columns
    number = {n: finite(F.col(f"`{n}`").try_cast("double")) for n in names}
    stamp = F.col(f"`{index}`").try_cast("timestamp_ntz")
    timed = raw.agg(F.max(stamp != F.date_trunc("day", stamp).cast("timestamp_ntz"))).first()[0]
    return raw.select(
        F.lit(panel).alias(PANEL),
        (stamp if timed else stamp.cast("date")).alias(TS),
        *[c.alias(n) for n, c in number.items()],
    )


def read_wide_panel(spark: SparkSession, path: str, panel: str = "default") -> DataFrame:
    """Long bars of a Date x ticker CSV. Empty cells stay as NULL prices, so no date is lost."""
    return from_wide(_wide(spark, path, panel), PRICE).select(PANEL, SYMBOL, TS, PRICE)


def read_indicators(spark: SparkSession, path: str, kind: str) -> DataFrame | None:
    """Long indicator rows of a Date x series CSV, or None if there is no such file."""
    try:
        wide = _wide(spark, path, kind)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return (
        from_wide(wide, "value")
        .where(F.col("value").isNotNull())
        .select(F.col(SYMBOL).alias("series_id"), F.lit(kind).alias("kind"), TS, "value")
    )


def read_stored(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Parquet output of an earlier stage; filter and columns reach the scan."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


read_features = read_stored
read_regimes = read_stored
