"""Lagged, cross-sectional, interaction and exogenous features; calendar filters; imputation."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.calendar import is_federal_holiday, is_weekend
from panelspark.functions.numeric import ratio
from panelspark.operators.blocks import (
    BLOCK_ROWS,
    block_window,
    core,
    figures,
    panel_calendar,
    positions,
    quantiles,
    running,
    series_blocks,
    shift,
    spread,
    with_figures,
    without_positions,
)
from panelspark.operators.indicators import all_indicators
from panelspark.schema import CELL, PANEL, POS, PRICE, SERIES, SYMBOL, TS, require
from panelspark.session import stage

LOG = logging.getLogger(__name__)
LAGS = (1, 5, 21)
INTERACTIONS = (("sma_20", "ema_12"), ("rsi_14", "macd"))
SPARSE = 0.8  # fixed value: share of missing values above which a column is filled
META = (*CELL, POS, "n_dates", PRICE)


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in META]


# --- added features -------------------------------------------------------------------


def lag_features(
    df: DataFrame,
    columns: Sequence[str],
    lags: Sequence[int] = LAGS,
    symbols: Sequence[str] | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Values ``k`` panel dates earlier; unknown columns are ignored.

    ``symbols`` restricts which series get lags (the others get NULL).
    """
    known = [c for c in columns if c in df.columns]
    if not known:
        return df
    halo, w = max(lags), block_window()
    placed = positions(df)
    chosen = F.lit(True) if symbols is None else F.col(SYMBOL).isin(list(symbols))
    lagged = [
        F.when(chosen, shift(F.col(c), k, w)).alias(f"{c}_lag_{k}") for c in known for k in lags
    ]
    return core(
        series_blocks(placed, halo, block_rows=block_rows).select("*", *lagged), halo, block_rows
    )


def _rank(column: str) -> Column:
    """Percentile rank on a date: one window, one exchange by date; ties share their mean rank."""
    date = Window.partitionBy(PANEL, TS)
    place = F.rank().over(date.orderBy(F.col(column).asc_nulls_last()))
    equal = F.count(F.lit(1)).over(Window.partitionBy(PANEL, TS, column))
    return F.when(F.col(column).isNotNull(), (place + (equal - 1) / 2) / F.count(column).over(date))


def cs_rank(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Percentile rank among the panel's symbols on each date; ties share their mean rank."""
    return df.withColumn(out or f"{column}_rank", _rank(column))


def _moments(df: DataFrame, column: str) -> DataFrame:
    """Mean and deviation per date, aggregated before the exchange."""
    return df.groupBy(PANEL, TS).agg(
        F.avg(column).alias("_mean"), F.stddev_samp(column).alias("_std")
    )


def cs_zscore(df: DataFrame, column: str) -> DataFrame:
    z = ratio(F.col(column) - F.col("_mean"), F.col("_std"))
    return (
        df.join(_moments(df, column), [PANEL, TS])
        .withColumn(f"{column}_zscore", z)
        .drop("_mean", "_std")
    )


def cs_deviation(df: DataFrame, column: str) -> DataFrame:
    return (
        df.join(_moments(df, column), [PANEL, TS])
        .withColumn(f"{column}_dev_mean", F.col(column) - F.col("_mean"))
        .drop("_mean", "_std")
    )


def cross_sectional(df: DataFrame, column: str = "return_daily") -> DataFrame:
    """Rank, z-score and deviation from the mean per date, all from one exchange by date."""
    date = Window.partitionBy(PANEL, TS)
    mean, spread_ = F.avg(column).over(date), F.stddev_samp(column).over(date)
    return df.withColumns(
        {
            f"{column}_rank": _rank(column),
            f"{column}_zscore": ratio(F.col(column) - mean, spread_),
            f"{column}_dev_mean": F.col(column) - mean,
        }
    )


def interactions(
    df: DataFrame, pairs: Sequence[tuple[str, str]] = INTERACTIONS
) -> DataFrame:
    """Products of two features of the same series; pairs with an unknown name are skipped."""
    out = []
    for a, b in pairs:
        if a in df.columns and b in df.columns:
            out.append((F.col(a) * F.col(b)).alias(f"{a}_x_{b}"))
        else:
            LOG.warning("no such feature pair: %s, %s", a, b)
    return df.select("*", *out)


# --- calendar filters -----------------------------------------------------------------


def remove_weekends(df: DataFrame) -> DataFrame:
    return without_positions(df.where(~is_weekend(F.col(TS))))


def remove_holidays(df: DataFrame) -> DataFrame:
    """Drop observed US federal holidays (not exchange holidays)."""
    return without_positions(df.where(~is_federal_holiday(F.col(TS))))


# --- filling --------------------------------------------------------------------------


def fill_both_ways(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = tuple(SERIES),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Last known value, before the first one the first known value."""
    scans = {f"_p_{c}": ("last", F.col(c)) for c in columns}
    scans |= {f"_n_{c}": ("next", F.col(c)) for c in columns}
    kept = [c for c in df.columns if c not in columns]
    return running(df, keys, scans, block_rows).select(
        *kept, *[F.coalesce(f"_p_{c}", f"_n_{c}").alias(c) for c in columns]
    )


def complete_rows(df: DataFrame) -> DataFrame:
    """Add the panel dates before a symbol's first row, with NULL features."""
    calendar = panel_calendar(df)
    placed = positions(df)
    names = [c for c in df.columns if c not in (*CELL, POS, "n_dates")]
    first = placed.groupBy(*SERIES).agg(
        F.min(POS).alias("first"), F.max("n_dates").alias("n_dates")
    )
    lead = (
        spread(first, F.lit(0).cast("bigint"), F.col("first") - 1, POS)
        .drop("first")
        .join(calendar.drop("n_dates"), [PANEL, POS])
        .select("*", *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in names])
    )
    return placed.unionByName(lead)


def fill_sparse(
    df: DataFrame,
    columns: Sequence[str],
    threshold: float = SPARSE,
    skip_warmup: bool = True,
    keys: Sequence[str] = tuple(SERIES),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Fill, forwards then backwards, the series of a column that are mostly missing.

    A rolling feature is missing at its start by construction. ``skip_warmup`` measures the
    share from the first value on, so that such a column is not filled backwards. One row
    with a flag per column tells which columns need filling at all.
    """
    keys = list(keys)
    placed = positions(df)

    def missing(c: str):
        start = F.min(F.when(F.col(c).isNotNull(), F.col(POS))) if skip_warmup else F.lit(0)
        rows = F.max("n_dates") - start
        return (1 - ratio(F.count(c).cast("double"), rows) > threshold).alias(f"_s_{c}")

    sparse = figures(placed, keys, *[missing(c) for c in columns])
    flags = sparse.agg(*[F.max(f"_s_{c}").alias(c) for c in columns]).first()
    columns = [c for c in columns if flags[c]]
    if not columns:
        return placed
    sparse = sparse.select(*keys, "_blocks", *[f"_s_{c}" for c in columns])
    filled = fill_both_ways(
        placed.select("*", *[F.col(c).alias(f"_f_{c}") for c in columns]),
        [f"_f_{c}" for c in columns],
        keys,
        block_rows,
    )
    kept = [c for c in placed.columns if c not in columns]
    return with_figures(filled, sparse, keys).select(
        *kept,
        *[F.when(F.col(f"_s_{c}"), F.col(f"_f_{c}")).otherwise(F.col(c)).alias(c) for c in columns],
    )


def impute_ffill(df: DataFrame, columns: Sequence[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    placed = positions(df)
    return fill_both_ways(placed, columns, block_rows=block_rows)


def impute_interpolate(
    df: DataFrame, columns: Sequence[str], block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Linear between neighbours by row position; flat before the first and after the last."""
    placed = positions(df)
    points = {
        c: F.when(F.col(c).isNotNull(), F.struct(F.col(POS).alias("p"), F.col(c).alias("v")))
        for c in columns
    }
    scans = {f"_a_{c}": ("last", x) for c, x in points.items()}
    scans |= {f"_z_{c}": ("next", x) for c, x in points.items()}
    both = running(placed, SERIES, scans, block_rows)

    def line(c: str):
        a, z = F.col(f"_a_{c}"), F.col(f"_z_{c}")
        step = ratio((F.col(POS) - a["p"]).cast("double"), (z["p"] - a["p"]).cast("double"))
        between = a["v"] + (z["v"] - a["v"]) * step
        return F.coalesce(F.col(c), between, a["v"], z["v"]).alias(c)

    kept = [c for c in placed.columns if c not in columns]
    return both.select(*kept, *[line(c) for c in columns])


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    means = figures(df, SERIES, *[F.avg(c).alias(f"_m_{c}") for c in columns])
    return _coalesce_from(df, means, columns)


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact medians of all columns in one pass over their long form."""
    long = df.unpivot(list(SERIES), list(columns), "feature", "value")
    medians = (
        quantiles(long, [*SERIES, "feature"], "value", {"median": 0.5})
        .groupBy(*SERIES)
        .pivot("feature", list(columns))
        .agg(F.first("median"))
    )
    renamed = medians.select(*SERIES, *[F.col(c).alias(f"_m_{c}") for c in columns])
    return _coalesce_from(df, renamed, columns)


def _coalesce_from(df: DataFrame, fills: DataFrame, columns: Sequence[str]) -> DataFrame:
    kept = [c for c in df.columns if c not in columns]
    return with_figures(df, fills, SERIES, "left").select(
        *kept, *[F.coalesce(F.col(c), F.col(f"_m_{c}")).alias(c) for c in columns]
    )


IMPUTERS = {
    "interpolate": impute_interpolate,
    "forward_fill": impute_ffill,
    "mean": impute_mean,
    "median": impute_median,
}


# --- dropping -------------------------------------------------------------------------


def empty_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(series, feature) pairs without a single value."""
    counted = df.groupBy(*SERIES).agg(*[F.count(c).alias(c) for c in columns])
    return (
        counted.unpivot(list(SERIES), list(columns), "feature", "n_values")
        .where("n_values = 0")
        .drop("n_values")
    )


def drop_incomplete(
    df: DataFrame,
    columns: Sequence[str],
    scope: str = "date",
    ignore_empty: bool = True,
) -> DataFrame:
    """Drop a date if any feature of any of its symbols is missing (``scope='date'``), or only
    the incomplete rows (``'row'``). Features a series never has do not count."""
    if scope not in ("date", "row"):
        raise ValueError(f"unknown scope: {scope}")
    columns = list(columns)
    have = figures(df, SERIES, *[(F.count(c) > 0).alias(f"_h_{c}") for c in columns])
    used = F.lit(False)
    whole = F.lit(True)
    for c in columns:
        used = used | F.col(f"_h_{c}")
        whole = whole & (F.col(c).isNotNull() | (~F.col(f"_h_{c}") if ignore_empty else F.lit(False)))
    flagged = with_figures(df, have, SERIES).withColumn("_whole", whole)
    kept = [c for c in df.columns if c not in (POS, "n_dates")]  # dates go, so positions change
    if scope == "row":
        return flagged.where("_whole").select(*kept)
    roster = have.where(used if ignore_empty else F.lit(True)).groupBy(PANEL).agg(
        F.count(F.lit(1)).alias("n")
    )
    by_date = flagged.groupBy(PANEL, TS).agg(
        F.count_if(F.col("_whole") & (used if ignore_empty else F.lit(True))).alias("k")
    )
    good = (
        with_figures(by_date, roster, [PANEL])
        .where(F.col("k") == F.col("n"))
        .select(PANEL, TS)
    )
    return df.select(*kept).join(good, [PANEL, TS], "left_semi")


# --- pipelines ------------------------------------------------------------------------


def clean_features(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    weekends: bool = True,
    threshold: float = SPARSE,
    impute: str | None = "interpolate",
    skip_warmup: bool = True,
    scope: str = "date",
) -> DataFrame:
    """Weekends, holidays, sparse columns, empty columns, imputation, incomplete dates."""
    if impute is not None and impute not in IMPUTERS:
        raise ValueError(f"unknown imputation: {impute}")
    columns = list(columns or feature_columns(df))
    kept = remove_holidays(remove_weekends(df) if weekends else df)
    kept = fill_sparse(stage(complete_rows(kept)), columns, threshold, skip_warmup)
    if impute is not None:
        kept = IMPUTERS[impute](kept, columns)
    names = [c for c in df.columns if c not in (POS, "n_dates")]
    return drop_incomplete(stage(kept), columns, scope).select(*names)


def exogenous(
    dates: DataFrame,
    indicators: DataFrame,
    series: Sequence[str],
    mode: str = "asof",
    threshold: float = SPARSE,
) -> DataFrame:
    """One row per date with a column per indicator series.

    ``mode='asof'`` carries the last value known on any calendar day. ``'reference'`` first
    drops weekends and holidays, values dated on them included, and then fills sparse series
    forwards and backwards. Works on the union of both calendars.
    """
    if mode not in ("asof", "reference"):
        raise ValueError(f"unknown mode: {mode}")
    wide = indicators.groupBy(TS).pivot("series_id", list(series)).agg(F.first("value"))
    union = dates.select(TS).distinct().join(wide, TS, "full_outer")
    if mode == "reference":
        union = remove_holidays(remove_weekends(union))
    union = positions(stage(union.withColumn(PANEL, F.lit("exogenous"))))
    if mode == "asof":
        union = running(union, [PANEL], {c: ("last", F.col(f"`{c}`")) for c in series})
    else:
        union = fill_sparse(union, series, threshold, skip_warmup=False, keys=[PANEL])
    return union.select(TS, *[F.col(f"`{c}`") for c in series])


def join_exogenous(
    features: DataFrame,
    indicators: DataFrame,
    series: Sequence[str],
    mode: str = "asof",
    threshold: float = SPARSE,
) -> DataFrame:
    """Indicator columns joined on the date; the date table is small and joins by its size."""
    table = exogenous(features, indicators, series, mode, threshold)
    return features.join(table, TS, "left")


def build_features(
    bars: DataFrame,
    macro: tuple[DataFrame, Sequence[str]] | None = None,
    sentiment: tuple[DataFrame, Sequence[str]] | None = None,
    benchmark: str = "SPY",
    include_lags: bool = True,
    include_cross_sectional: bool = True,
    include_interaction: bool = True,
    impute: str | None = None,
    exogenous_mode: str = "reference",
    skip_warmup: bool = True,
    lag_symbols: Sequence[str] | None = None,
    clean: bool = True,
) -> DataFrame:
    """Indicators, lags, cross-section, interactions and exogenous series, cleaned.

    ``macro`` and ``sentiment`` are an indicator table with the list of its series.
    """
    require(bars, *CELL, PRICE)
    base = stage(all_indicators(bars, benchmark))
    if clean:  # exogenous series also have their values on the dates before a symbol's first row
        base = complete_rows(base)
    out = base
    if include_lags:
        out = lag_features(out, ["return_daily"], LAGS, lag_symbols)
    if include_cross_sectional:
        out = cross_sectional(out)
    if include_interaction:
        out = interactions(out)
    columns = feature_columns(out)
    for source in (macro, sentiment):
        if source is not None:
            table = exogenous(base, source[0], source[1], exogenous_mode)
            out = out.join(table, TS, "left")
            columns += [c for c in source[1] if c not in columns]
    if not clean:
        return out
    return clean_features(out, columns, impute=impute, skip_warmup=skip_warmup)
