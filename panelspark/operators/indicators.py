"""Returns and technical indicators per series (defaults are the usual market ones).

Indicators that are empty wherever the price is absent run on the observed rows only.
Those that carry a value onto absent dates (padded returns and what derives from them,
exponential averages) return a row for every panel date from the first observation on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from panelspark.functions.numeric import TRADING_DAYS, log_positive, ratio
from panelspark.operators.blocks import (
    BLOCK_ROWS,
    block_window,
    core,
    full,
    padded_grid,
    panel_calendar,
    positions,
    series_blocks,
    shift,
)
from panelspark.operators.ema import (
    ema_step,
    held_ema_step,
    observed,
    observed_blocks,
    reach,
    until_next,
)
from panelspark.schema import CELL, PANEL, POS, PRICE, SERIES, SYMBOL, TS, require

RETURN_PERIODS = (1, 5, 21, 63)
SMA_WINDOWS = (20, 50, 200)
EMA_SPANS = (12, 26, 50)
MOMENTUM_WINDOWS = (10, 20, 50)
VOL_WINDOWS = (20, 60, 252)


def return_name(k: int) -> str:
    return "return_daily" if k == 1 else f"return_{k}d"


# --- column builders on a window over one block ---------------------------------------


def return_columns(periods: Sequence[int], w: WindowSpec, price: str) -> dict[str, Column]:
    p = F.col(price)
    return {return_name(k): ratio(p, shift(p, k, w)) - 1 for k in periods}


def log_return_column(w: WindowSpec) -> dict[str, Column]:
    p = F.col(PRICE)
    return {"log_return": log_positive(ratio(p, shift(p, 1, w)))}


def sma_columns(windows: Sequence[int], w: WindowSpec) -> dict[str, Column]:
    p = F.col(PRICE)
    return {f"sma_{n}": full(p, n, w, F.avg(p)) for n in windows}


def rsi_column(window: int, w: WindowSpec, delta: str = "_delta") -> dict[str, Column]:
    d = F.col(delta)
    gain = full(d, window, w, F.avg(F.when(d.isNotNull(), F.greatest(d, F.lit(0.0)))))
    loss = full(d, window, w, F.avg(F.when(d.isNotNull(), F.greatest(-d, F.lit(0.0)))))
    rsi = F.when(loss > 0, 100 - 100 / (1 + gain / loss)).when(gain > 0, F.lit(100.0))
    return {f"rsi_{window}": rsi}


def bollinger_columns(window: int, num_std: float, w: WindowSpec) -> dict[str, Column]:
    p = F.col(PRICE)
    mid = full(p, window, w, F.avg(p))
    half = full(p, window, w, F.stddev_samp(p)) * num_std
    return {
        "bb_upper": mid + half,
        "bb_lower": mid - half,
        "bb_width": ratio(half * 2, mid),
        "bb_pct": ratio(p - (mid - half), half * 2),
    }


def momentum_columns(windows: Sequence[int], w: WindowSpec) -> dict[str, Column]:
    p = F.col(PRICE)
    return {f"momentum_{n}": ratio(p, shift(p, n, w)) - 1 for n in windows}


def volatility_columns(windows: Sequence[int], w: WindowSpec, ret: str) -> dict[str, Column]:
    r = F.col(ret)
    return {
        f"vol_{n}": full(r, n, w, F.stddev_samp(r)) * F.sqrt(F.lit(float(TRADING_DAYS)))
        for n in windows
    }


def correlation_column(ret: str, bench: str, window: int, w: WindowSpec) -> Column:
    both = F.col(ret).isNotNull() & F.col(bench).isNotNull()
    x, y = F.when(both, F.col(ret)), F.when(both, F.col(bench))
    rho = ratio(F.covar_samp(x, y).over(w.rangeBetween(-(window - 1), 0)),
                F.stddev_samp(x).over(w.rangeBetween(-(window - 1), 0))
                * F.stddev_samp(y).over(w.rangeBetween(-(window - 1), 0)))
    full_pairs = F.count(x).over(w.rangeBetween(-(window - 1), 0)) == window
    return F.when(full_pairs, F.greatest(F.least(rho, F.lit(1.0)), F.lit(-1.0)))


# --- operators ------------------------------------------------------------------------


def _add(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select("*", *[c.alias(n) for n, c in columns.items()])


def _on_observed(bars: DataFrame, halo: int, block_rows: int) -> DataFrame:
    require(bars, *CELL, PRICE)
    rows = positions(bars).select(*CELL, POS, "n_dates", PRICE).where(F.col(PRICE).isNotNull())
    return series_blocks(rows, halo, block_rows=block_rows)


def _finish(df: DataFrame, halo: int, names: Sequence[str], block_rows: int) -> DataFrame:
    return core(df, halo, block_rows).select(*CELL, POS, "n_dates", *names)


def returns(
    bars: DataFrame,
    periods: Sequence[int] = RETURN_PERIODS,
    pad: bool = True,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Simple returns over ``periods`` dates; ``pad`` carries the last price over gaps."""
    halo, w = max(periods), block_window()
    if pad:
        rows = padded_grid(bars, halo, block_rows=block_rows)
        block_rows = max(block_rows, halo + 1)
        columns = return_columns(periods, w, f"{PRICE}_pad")
    else:
        rows = _on_observed(bars, halo, block_rows)
        columns = return_columns(periods, w, PRICE)
    return _finish(_add(rows, columns), halo, list(columns), block_rows)


def log_return(bars: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    columns = log_return_column(block_window())
    return _finish(_add(_on_observed(bars, 1, block_rows), columns), 1, list(columns), block_rows)


def sma(bars: DataFrame, windows: Sequence[int] = SMA_WINDOWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    halo, columns = max(windows), sma_columns(windows, block_window())
    return _finish(_add(_on_observed(bars, halo, block_rows), columns), halo, list(columns), block_rows)


def rsi(bars: DataFrame, window: int = 14, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Relative strength from *simple* rolling means of gains and losses."""
    w, p = block_window(), F.col(PRICE)
    halo = window + 1
    rows = _on_observed(bars, halo, block_rows).withColumn("_delta", p - shift(p, 1, w))
    columns = rsi_column(window, w)
    return _finish(_add(rows, columns), halo, list(columns), block_rows)


def bollinger(
    bars: DataFrame, window: int = 20, num_std: float = 2.0, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    columns = bollinger_columns(window, num_std, block_window())
    return _finish(
        _add(_on_observed(bars, window, block_rows), columns), window, list(columns), block_rows
    )


def momentum(
    bars: DataFrame, windows: Sequence[int] = MOMENTUM_WINDOWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    halo, columns = max(windows), momentum_columns(windows, block_window())
    return _finish(_add(_on_observed(bars, halo, block_rows), columns), halo, list(columns), block_rows)


def volatility(
    bars: DataFrame, windows: Sequence[int] = VOL_WINDOWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Annualised rolling standard deviation of padded daily returns."""
    halo, w = max(windows) + 1, block_window()
    grid = _add(padded_grid(bars, halo, block_rows=block_rows), return_columns([1], w, f"{PRICE}_pad"))
    columns = volatility_columns(windows, w, "return_daily")
    return _finish(_add(grid, columns), halo, list(columns), max(block_rows, halo + 1))


def benchmark_returns(bars: DataFrame, benchmark: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Padded daily returns ``_bench`` of one symbol per panel and position."""
    one = bars.where(F.col(SYMBOL) == benchmark)
    grid = padded_grid(
        one, 1, block_rows=block_rows, with_stamps=False, calendar=panel_calendar(bars)
    )
    daily = return_columns([1], block_window(), f"{PRICE}_pad")
    return core(_add(grid, daily), 1, max(block_rows, 2)).select(
        PANEL, POS, F.col("return_daily").alias("_bench")
    )


def rolling_correlation(
    bars: DataFrame, benchmark: str = "SPY", window: int = 60, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Rolling correlation with the benchmark of the same panel; the benchmark is left out."""
    halo, w = window + 1, block_window()
    grid = _add(padded_grid(bars, halo, block_rows=block_rows), return_columns([1], w, f"{PRICE}_pad"))
    has_benchmark = bars.where(F.col(SYMBOL) == benchmark).select(PANEL).distinct()
    pairs = (
        grid.where(F.col(SYMBOL) != benchmark)
        .join(has_benchmark, PANEL, "left_semi")
        .join(benchmark_returns(bars, benchmark, block_rows), [PANEL, POS], "left")
    )
    name = f"corr_{benchmark}_{window}"
    columns = {name: correlation_column("return_daily", "_bench", window, w)}
    return _finish(_add(pairs, columns), halo, [name], max(block_rows, halo + 1))


def ema(bars: DataFrame, spans: Sequence[int] = EMA_SPANS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    rows = observed_blocks(observed(bars, PRICE), reach(max(spans)), block_rows)
    for s in spans:
        rows = ema_step(rows, PRICE, s, f"ema_{s}")
    return until_next(rows, [F.col(f"ema_{s}") for s in spans], panel_calendar(bars)).select(
        *CELL, POS, *[f"ema_{s}" for s in spans]
    )


def _macd_steps(rows: DataFrame, fast: str, slow: str, signal: int) -> DataFrame:
    rows = rows.withColumn("macd", F.col(fast) - F.col(slow))
    return held_ema_step(rows, "macd", signal, "_signal")


def _macd_columns(signal: int) -> list[Column]:
    """On absent dates the line is held, so the signal keeps approaching it."""
    q = 1 - 2 / (signal + 1)
    held = F.pow(F.lit(q), F.col("held"))
    sig = F.col("macd") + held * (F.col("_signal") - F.col("macd"))
    return [F.col("macd"), sig.alias("macd_signal"), (F.col("macd") - sig).alias("macd_hist")]


def macd(
    bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    halo = reach(max(fast, slow)) + reach(signal)
    rows = observed_blocks(observed(bars, PRICE), halo, block_rows)
    rows = ema_step(rows, PRICE, fast, "_fast")
    rows = ema_step(rows, PRICE, slow, "_slow")
    rows = _macd_steps(rows, "_fast", "_slow", signal)
    return until_next(rows, _macd_columns(signal), panel_calendar(bars)).select(
        *CELL, POS, "macd", "macd_signal", "macd_hist"
    )


def true_range(bars: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """max(h-l, |h-c'|, |l-c'|) with c' the close one date earlier; NULL without c'."""
    require(bars, *CELL, "high", "low", PRICE)
    w = block_window()
    rows = series_blocks(positions(bars), 1, block_rows=block_rows).withColumn(
        "_prev", shift(F.col(PRICE), 1, w)
    )
    h, low, c = F.col("high"), F.col("low"), F.col("_prev")
    tr = F.when(
        h.isNotNull() & low.isNotNull() & c.isNotNull(),
        F.greatest(h - low, F.abs(h - c), F.abs(low - c)),
    )
    return core(rows.withColumn("true_range", tr), 1, block_rows).select(
        *CELL, POS, "n_dates", "true_range"
    )


def atr(bars: DataFrame, window: int = 14, block_rows: int = BLOCK_ROWS) -> DataFrame:
    rows = true_range(bars, block_rows).where(F.col("true_range").isNotNull())
    name = f"atr_{window}"
    rows = ema_step(observed_blocks(rows, reach(window), block_rows), "true_range", window, name)
    return until_next(rows, [F.col(name)], panel_calendar(bars)).select(*CELL, POS, name)


def all_windowed(
    bars: DataFrame,
    periods: Sequence[int] = RETURN_PERIODS,
    sma: Sequence[int] = SMA_WINDOWS,
    vol: Sequence[int] = VOL_WINDOWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Padded returns, moving averages and volatility: one blocked exchange, one sort."""
    halo, w = max(*periods, *sma, *vol) + 1, block_window()
    grid = padded_grid(bars, halo, block_rows=block_rows)
    first = return_columns(dict.fromkeys([1, *periods]), w, f"{PRICE}_pad")
    columns = {**sma_columns(sma, w), **volatility_columns(vol, w, "return_daily")}
    names = [return_name(k) for k in periods] + list(columns)
    return _finish(_add(_add(grid, first), columns), halo, names, max(block_rows, halo + 1))


def all_indicators(
    bars: DataFrame,
    benchmark: str = "SPY",
    with_macd: bool = True,
    with_bollinger: bool = True,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every indicator side by side on the padded grid.

    The windowed ones share one blocked exchange and one sort; the exponential averages
    share one scan and are joined on the cell key. ``benchmark`` is used where a panel has
    that symbol, the true range where the bars have high and low.
    """
    ohlc = {"high", "low"} <= set(bars.columns)
    halo, w = max(VOL_WINDOWS) + 1, block_window()
    p = F.col(PRICE)
    grid = padded_grid(bars, halo, block_rows=block_rows)
    grid = _add(
        grid,
        {**return_columns(RETURN_PERIODS, w, f"{PRICE}_pad"), "_delta": p - shift(p, 1, w)},
    )
    grid = grid.join(benchmark_returns(bars, benchmark, block_rows), [PANEL, POS], "left")
    columns: dict[str, Column] = {
        **log_return_column(w),
        **sma_columns(SMA_WINDOWS, w),
        **rsi_column(14, w),
        **(bollinger_columns(20, 2.0, w) if with_bollinger else {}),
        **momentum_columns(MOMENTUM_WINDOWS, w),
        **volatility_columns(VOL_WINDOWS, w, "return_daily"),
        f"corr_{benchmark}_60": F.when(
            F.col(SYMBOL) != benchmark, correlation_column("return_daily", "_bench", 60, w)
        ),
    }
    names = [return_name(k) for k in RETURN_PERIODS] + list(columns)
    windowed = core(_add(grid, columns), halo, max(block_rows, halo + 1)).select(
        *CELL, POS, "n_dates", PRICE, *names
    )

    spans = dict.fromkeys([*EMA_SPANS, 12, 26] if with_macd else EMA_SPANS)
    reach_back = reach(max(spans)) + (reach(9) if with_macd else 0)
    rows = observed_blocks(observed(bars, PRICE), reach_back, block_rows)
    for s in spans:
        rows = ema_step(rows, PRICE, s, f"ema_{s}")
    carried = [F.col(f"ema_{s}") for s in spans]
    if with_macd:
        rows = _macd_steps(rows, "ema_12", "ema_26", 9)
        carried += _macd_columns(9)
    averages = until_next(rows, carried, panel_calendar(bars)).drop(TS)
    out = windowed.join(averages, [*SERIES, POS], "left")
    if ohlc:
        out = out.join(atr(bars, 14, block_rows).drop(TS), [*SERIES, POS], "left")
    return out
