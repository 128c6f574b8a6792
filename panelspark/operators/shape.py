"""Aligning, selecting, ordering and reshaping long panel tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.operators.blocks import (
    BLOCK_ROWS,
    padded_grid,
    panel_calendar,
    positions,
    spread,
    without_positions,
)
from panelspark.schema import CELL, PANEL, POS, PRICE, RET, SERIES, SYMBOL, TS, require


def align_outer(a: DataFrame, b: DataFrame, keys: Sequence[str] = (PANEL, TS)) -> DataFrame:
    """Union of keys, missing values NULL; a column present in both is taken from ``a``."""
    return a.join(drop_duplicate_columns(a, b, keys), list(keys), "full_outer")


def align_inner(a: DataFrame, b: DataFrame, keys: Sequence[str] = (PANEL, TS)) -> DataFrame:
    """Rows of both tables on their common keys."""
    return a.join(drop_duplicate_columns(a, b, keys), list(keys), "inner")


def on_common_dates(a: DataFrame, b: DataFrame, keys: Sequence[str] = (PANEL, TS)) -> DataFrame:
    """Rows of ``a`` whose key occurs in ``b``."""
    return a.join(b.select(*keys), list(keys), "left_semi")


def drop_duplicate_columns(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``b`` without the non-key columns that ``a`` already has: the first of each name wins."""
    return b.drop(*[c for c in b.columns if c in a.columns and c not in keys])


def densify(
    bars: DataFrame, values: Sequence[str] = (PRICE,), block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """A row for every symbol and panel date; absent values are NULL.

    From the first observation on, rows stand for the gap behind them; the dates before it
    are one sequence per symbol. No symbol x date product is formed.
    """
    calendar = panel_calendar(bars)
    present = F.coalesce(*[F.col(v) for v in values]).isNotNull()
    grid = padded_grid(bars, 0, values, values[0], block_rows, with_stamps=False)
    first = (
        positions(bars)
        .groupBy(*SERIES)
        .agg(
            F.coalesce(F.min(F.when(present, F.col(POS))), F.max("n_dates")).alias("first"),
        )
    )
    lead = spread(first, F.lit(0).cast("bigint"), F.col("first") - 1, POS).select(
        *SERIES,
        POS,
        *[F.lit(None).cast("double").alias(v) for v in values],
    )
    return (
        grid.select(*SERIES, POS, *values)
        .unionByName(lead)
        .join(calendar.select(PANEL, POS, TS), [PANEL, POS])
        .select(*CELL, POS, *values)
    )


def to_wide(df: DataFrame, value: str, symbols: Iterable[str]) -> DataFrame:
    """Date x symbol table for export; ``symbols`` fixes the columns."""
    return df.groupBy(PANEL, TS).pivot(SYMBOL, list(symbols)).agg(F.first(value))


def from_wide(df: DataFrame, value: str = PRICE, keys: Sequence[str] = (PANEL, TS)) -> DataFrame:
    """Long rows of a date x symbol table."""
    columns = [c for c in df.columns if c not in keys]
    return df.unpivot(list(keys), [F.col(f"`{c}`") for c in columns], SYMBOL, value)


def matching_columns(columns: Sequence[str], patterns: Sequence[str]) -> list[str]:
    """Columns in which any pattern occurs, each once, in table order."""
    return [c for c in columns if any(re.search(p, c) for p in patterns)]


def select_features(
    df: DataFrame, patterns: Sequence[str], keys: Sequence[str] = tuple(CELL)
) -> DataFrame:
    features = [c for c in df.columns if c not in keys]
    return df.select(*keys, *matching_columns(features, patterns))


def order_by_time(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by panel and time, ready to be written in order."""
    order = [PANEL, TS] + ([SYMBOL] if SYMBOL in df.columns else [])
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def top_k(df: DataFrame, k: int, by: Sequence[Column], keys: Sequence[str] = ()) -> DataFrame:
    """The first ``k`` rows by ``by``, per group if ``keys`` are given.

    Spark limits each input partition to ``k`` rows per group before the exchange in both
    forms, so a large group costs no more than a small one.
    """
    if not keys:
        return df.orderBy(*by).limit(k)
    w = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# fixed values: name fragments of each feature family
FEATURE_FAMILIES = {
    "Returns": ["return"],
    "SMA": ["sma"],
    "EMA": ["ema"],
    "RSI": ["rsi"],
    "MACD": ["macd"],
    "Bollinger": ["bb"],
    "Momentum": ["momentum"],
    "Volatility": ["vol"],
    "Correlation": ["corr"],
    "Lags": ["lag"],
    "Cross-sectional": ["rank", "zscore", "dev_mean"],
    "Interaction": ["_x_"],
}


def feature_family_counts(
    features: DataFrame, keys: Sequence[str] = (*CELL, POS)
) -> DataFrame:
    """Number of feature columns and of filled values per family and panel."""
    names = [c for c in features.columns if c not in keys]
    families = {f: matching_columns(names, pats) for f, pats in FEATURE_FAMILIES.items()}
    families = {f: cols for f, cols in families.items() if cols}
    counted = features.groupBy(PANEL).agg(*[F.count(c).alias(c) for c in names])
    rows = F.array(
        *[
            F.struct(
                F.lit(f).alias("family"),
                F.lit(len(cols)).alias("n_features"),
                sum((F.col(c) for c in cols[1:]), F.col(cols[0])).alias("n_values"),
            )
            for f, cols in families.items()
        ]
    )
    return counted.select(PANEL, F.inline(rows))


def complete_cases(returns: DataFrame, value: str = RET) -> DataFrame:
    """Only dates on which every symbol of the panel has a value."""
    require(returns, *CELL, value)
    roster = returns.select(*SERIES).distinct().groupBy(PANEL).agg(F.count(F.lit(1)).alias("n"))
    whole = (
        returns.groupBy(PANEL, TS)
        .agg(F.count(value).alias("filled"))
        .join(roster, PANEL)
        .where(F.col("filled") == F.col("n"))
    )
    kept = returns.join(whole.select(PANEL, TS), [PANEL, TS], "left_semi")
    return without_positions(kept)
