"""Market-level series per date, and means, covariances and correlations per panel."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.numeric import TRADING_DAYS, ratio
from panelspark.operators.blocks import (
    BLOCK,
    BLOCK_ROWS,
    block_window,
    core,
    full,
    positions,
    series_blocks,
)
from panelspark.schema import CELL, PANEL, POS, RET, SERIES, SYMBOL, TS, require

TILE = 256  # symbols per tile of a covariance or correlation task
CHUNK = 1_024  # dates per task


def market_return(returns: DataFrame) -> DataFrame:
    """Equal-weighted mean per date."""
    return returns.groupBy(PANEL, TS).agg(F.avg(RET).alias("market_return"))


def dispersion(returns: DataFrame) -> DataFrame:
    """Cross-sectional standard deviation per date."""
    return returns.groupBy(PANEL, TS).agg(F.stddev_samp(RET).alias("dispersion"))


def market_volatility(
    returns: DataFrame, window: int = 21, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Annualised rolling deviation per symbol, averaged over the symbols that have one."""
    require(returns, *CELL, RET)
    r, w = F.col(RET), block_window()
    rows = series_blocks(positions(returns), window, block_rows=block_rows)
    vol = full(r, window, w, F.stddev_samp(r)) * F.sqrt(F.lit(float(TRADING_DAYS)))
    return (
        core(rows.withColumn("volatility", vol), window, block_rows)
        .groupBy(PANEL, TS)
        .agg(F.avg("volatility").alias("volatility"))
    )


def symbol_tiles(returns: DataFrame, keys: Sequence[str], tile: int = TILE) -> DataFrame:
    """One row per key and symbol: its mean, its tile and the number of tiles."""
    by_symbol = Window.partitionBy(*keys).orderBy(SYMBOL)
    return (
        returns.groupBy(*keys, SYMBOL)
        .agg(F.avg(RET).alias("centre"))
        .withColumn("tile", F.floor((F.row_number().over(by_symbol) - 1) / tile))
        .withColumn("n_tiles", F.max("tile").over(Window.partitionBy(*keys)) + 1)
    )


def _matrix(pdf: pd.DataFrame, value: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dates x symbols with NaN where a cell is absent, with sorted positions and symbols."""
    pos, pi = np.unique(pdf[POS].to_numpy(), return_inverse=True)
    sym, si = np.unique(pdf[SYMBOL].to_numpy(dtype=str), return_inverse=True)
    x = np.full((len(pos), len(sym)), np.nan)
    x[pi, si] = pdf[value].to_numpy(dtype=float)
    return x, pos, sym


def avg_pairwise_correlation(
    returns: DataFrame, window: int = 60, tile: int = TILE, block_rows: int = 4 * CHUNK
) -> DataFrame:
    """Mean correlation over all pairs in the ``window`` dates *before* each date.

    For standardised returns z the sum of all correlations is the variance of sum_i z_i, so a
    task standardises its symbols and sums them; the sums of several tiles add up. NULL where
    any symbol of the panel lacks a value or is constant in the window, however the blocks fall.
    """
    block_rows = max(block_rows, window)

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        x, pos, sym = _matrix(pdf, RET)
        start = int(pdf[BLOCK].iloc[0]) * block_rows
        rows = []
        for i in range(window, len(pos)):
            if pos[i] < start:
                continue
            past = x[i - window : i]
            spread = past.std(axis=0, ddof=1)
            whole = np.all(spread > 0) and pos[i] - pos[i - window] == window
            z = ((past - past.mean(axis=0)) / spread).sum(axis=1) if whole else np.full(window, np.nan)
            rows.append((pdf[PANEL].iloc[0], pos[i], z.tolist() if whole else None, len(sym), pdf["roster"].iloc[0]))
        return pd.DataFrame(rows, columns=[PANEL, POS, "z", "n", "roster"])

    placed = positions(returns.select(*CELL, RET))
    roster = F.count(F.lit(1)).over(Window.partitionBy(PANEL)).cast("int").alias("roster")
    tiles = symbol_tiles(returns, [PANEL], tile).select(*SERIES, "tile", roster)
    blocks = series_blocks(placed.join(tiles, SERIES), window, block_rows=block_rows)
    partial = blocks.groupBy(PANEL, BLOCK, "tile").applyInPandas(
        sums, f"{PANEL} string, {POS} long, z array<double>, n int, roster int"
    )
    dates = placed.groupBy(PANEL, POS, TS).agg(F.lit(1).alias("one")).drop("one")
    steps = partial.select(PANEL, POS, "n", "roster", F.posexplode_outer("z").alias("u", "zu"))
    total = (
        steps.groupBy(PANEL, POS, "u")
        .agg(F.sum("zu").alias("zu"), F.sum("n").alias("n"), F.max("roster").alias("roster"))
        .groupBy(PANEL, POS)
        .agg(
            F.when(
                (F.count_if(F.col("u").isNull()) == 0) & (F.min("n") == F.max("roster")), F.var_samp("zu")
            ).alias("v"),
            F.max("n").cast("double").alias("n"),
        )
        .select(
            PANEL,
            POS,
            ratio(F.col("v") - F.col("n"), F.col("n") * (F.col("n") - 1)).alias("correlation"),
        )
    )
    return dates.join(total, [PANEL, POS], "left").select(PANEL, TS, "correlation")


def regime_features(
    returns: DataFrame, volatility_window: int = 21, correlation_window: int = 60
) -> DataFrame:
    """Market return, volatility, correlation and dispersion; incomplete dates dropped."""
    daily = returns.groupBy(PANEL, TS).agg(
        F.avg(RET).alias("market_return"), F.stddev_samp(RET).alias("dispersion")
    )
    return (
        daily.join(market_volatility(returns, volatility_window), [PANEL, TS])
        .join(avg_pairwise_correlation(returns, correlation_window), [PANEL, TS])
        .select(PANEL, TS, "market_return", "volatility", "correlation", "dispersion")
        .dropna()
    )


# --- moments --------------------------------------------------------------------------

_SUMS = ("n", "sx", "sy", "sxy", "sxx", "syy")


def pair_sums(
    returns: DataFrame, keys: Sequence[str] = (PANEL,), tile: int = TILE, chunk: int = CHUNK
) -> DataFrame:
    """Sums over the dates on which both symbols of a matrix entry have a value.

    A task holds two tiles of symbols over one chunk of dates and forms the products as
    matrix products; the entries of all chunks are then added up. Returns are centred on the
    symbol mean first, so nothing cancels.
    """
    keys = list(keys)

    def products(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        head = pdf.iloc[0]
        x, _, sym = _matrix(pdf, "x")
        first = dict(zip(pdf[SYMBOL].astype(str), pdf["tile"]))
        left = np.array([first[s] == head["a"] for s in sym])
        right = np.array([first[s] == head["b"] for s in sym])
        m = (~np.isnan(x)).astype(float)
        x = np.nan_to_num(x)
        xl, ml, xr, mr = x[:, left], m[:, left], x[:, right], m[:, right]
        parts = {
            "n": ml.T @ mr,
            "sx": xl.T @ mr,
            "sy": ml.T @ xr,
            "sxy": xl.T @ xr,
            "sxx": (xl * xl).T @ mr,
            "syy": ml.T @ (xr * xr),
        }
        i, j = np.meshgrid(sym[left], sym[right], indexing="ij")
        out = pd.DataFrame({"sym_i": i.ravel(), "sym_j": j.ravel()})
        for k in keys:
            out[k] = head[k]
        for name, part in parts.items():
            out[name] = part.ravel()
        return out[(out["sym_i"] <= out["sym_j"]) & (out["n"] > 0)] if head["a"] == head["b"] else out[out["n"] > 0]

    placed = positions(returns.select(*dict.fromkeys([PANEL, *keys]), SYMBOL, TS, RET))
    tiles = symbol_tiles(returns, keys, tile)
    other = F.sequence(F.lit(0).cast("bigint"), F.col("n_tiles") - 1)
    pairs = F.transform(
        other, lambda o: F.struct(F.least("tile", o).alias("a"), F.greatest("tile", o).alias("b"))
    )
    rows = (
        placed.join(tiles, [*keys, SYMBOL])
        .withColumn("x", F.col(RET) - F.col("centre"))
        .where(F.col("x").isNotNull())
        .withColumn("chunk", F.floor(F.col(POS) / chunk))
        .withColumn("pair", F.explode(pairs))
        .select(*keys, SYMBOL, POS, "x", "tile", "chunk", "pair.a", "pair.b")
    )
    fields = ", ".join(
        ["sym_i string", "sym_j string"]
        + [f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys]
        + [f"{n} double" for n in _SUMS]
    )
    return (
        rows.groupBy(*keys, "chunk", "a", "b")
        .applyInPandas(products, fields)
        .groupBy(*keys, "sym_i", "sym_j")
        .agg(*[F.sum(n).alias(n) for n in _SUMS])
    )


def _both_triangles(df: DataFrame) -> DataFrame:
    i, j = F.col("sym_i"), F.col("sym_j")
    same = F.array(F.struct(i.alias("i"), j.alias("j")))
    both = F.array(F.struct(i.alias("i"), j.alias("j")), F.struct(j.alias("i"), i.alias("j")))
    rest = [c for c in df.columns if c not in ("sym_i", "sym_j")]
    return df.select(*rest, F.explode(F.when(i == j, same).otherwise(both)).alias("e")).select(
        *rest, F.col("e.i").alias("sym_i"), F.col("e.j").alias("sym_j")
    )


def covariance(
    returns: DataFrame, keys: Sequence[str] = (PANEL,), scale: float = 1.0, **sizes: int
) -> DataFrame:
    """Sample covariance of every pair on its common dates, as (sym_i, sym_j, cov) rows."""
    n = F.col("n")
    cov = ratio(F.col("sxy") - F.col("sx") * F.col("sy") / n, n - 1) * scale
    sums = pair_sums(returns, keys, **sizes)
    return _both_triangles(sums.select(*keys, "sym_i", "sym_j", cov.alias("cov")))


def correlation(returns: DataFrame, keys: Sequence[str] = (PANEL,), **sizes: int) -> DataFrame:
    """Pearson correlation of every pair on its common dates."""
    n = F.col("n")
    xy = F.col("sxy") - F.col("sx") * F.col("sy") / n
    xx = F.col("sxx") - F.col("sx") * F.col("sx") / n
    yy = F.col("syy") - F.col("sy") * F.col("sy") / n
    rho = F.greatest(F.least(ratio(xy, F.sqrt(xx * yy)), F.lit(1.0)), F.lit(-1.0))
    sums = pair_sums(returns, keys, **sizes)
    return _both_triangles(sums.select(*keys, "sym_i", "sym_j", rho.alias("corr")))


def mean_returns(
    returns: DataFrame, keys: Sequence[str] = (PANEL,), scale: float = 1.0
) -> DataFrame:
    return returns.groupBy(*keys, SYMBOL).agg((F.avg(RET) * scale).alias("mu"))


def annualised_moments(returns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mean and covariance times the number of trading days."""
    return mean_returns(returns, scale=TRADING_DAYS), covariance(returns, scale=TRADING_DAYS)


def with_regimes(returns: DataFrame, regimes: DataFrame) -> DataFrame:
    """Returns on the dates that have a regime, with it."""
    return returns.join(regimes.select(PANEL, TS, "regime"), [PANEL, TS])


def moments_by_regime(returns: DataFrame, regimes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mean and covariance per regime."""
    rows = with_regimes(returns, regimes)
    keys = [PANEL, "regime"]
    return mean_returns(rows, keys), covariance(rows, keys)


def regime_feature_stats(
    features: DataFrame, regimes: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Per regime, the mean over features of the feature means and of the deviations."""
    rows = features.join(regimes.select(PANEL, TS, "regime"), [PANEL, TS])
    per = rows.groupBy(PANEL, "regime").agg(
        F.array(*[F.avg(c) for c in columns]).alias("m"),
        F.array(*[F.stddev_samp(c) for c in columns]).alias("s"),
    )
    return per.select(PANEL, "regime", F.arrays_zip("m", "s").alias("ms")).select(
        PANEL, "regime", F.inline("ms")
    ).groupBy(PANEL, "regime").agg(
        F.avg("m").alias("mean_feature"), F.avg("s").alias("std_feature")
    )
