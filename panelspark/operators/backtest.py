"""Backtests of many strategies at once, in closed form per holding segment.

Between two rebalancing dates the weights only drift, so a segment needs its starting
weights and the growth of each asset since then; no day depends on the day before through a
loop. A segment is a handful of rows; wealth over segments is a two-level running product.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.numeric import TRADING_DAYS, ratio, sample_kurtosis, sample_skew
from panelspark.operators.blocks import (
    BLOCK_ROWS,
    block_window,
    core,
    full,
    positions,
    running,
    series_blocks,
    with_figures,
)
from panelspark.schema import PANEL, POS, RET, SYMBOL, TS
from panelspark.session import stage

STRATEGY = [PANEL, "strategy"]


def constant_weights(weights: DataFrame, returns: DataFrame) -> DataFrame:
    """The same weights on every date of the panel, one row per strategy, symbol and date."""
    cells = returns.select(PANEL, SYMBOL, TS)
    return with_figures(cells, weights.select(PANEL, SYMBOL, "strategy", "weight"), [PANEL, SYMBOL])


def _running_product(df: DataFrame, keys: Sequence[str], factors: dict[str, Column], block_rows: int) -> DataFrame:
    """Running products that survive zero and negative factors."""
    parts = {}
    for name, f in factors.items():
        parts[f"_m_{name}"] = ("sum", F.when(f != 0, F.ln(F.abs(f))).otherwise(0.0))
        parts[f"_s_{name}"] = ("sum", (f < 0).cast("double"))
        parts[f"_z_{name}"] = ("sum", (f == 0).cast("double"))
    scanned = running(df, keys, parts, block_rows)

    def product(name: str) -> Column:
        sign = F.when(F.col(f"_s_{name}") % 2 == 1, -1.0).otherwise(1.0)
        return F.when(F.col(f"_z_{name}") > 0, 0.0).otherwise(sign * F.exp(f"_m_{name}"))

    return scanned.select(*df.columns, *[product(n).alias(n) for n in factors])


def backtest(
    weights: DataFrame,
    returns: DataFrame,
    transaction_cost: float = 0.001,
    every: int = 21,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Daily ledger per strategy; costs are charged when weights are reset, every ``every`` dates.

    The drifted holdings and the daily sums are needed several times and are written once. A weight without
    a return, a holding without a weight at its opening, or one that skips a date raises an error.
    """
    missing = F.raise_error(F.lit("a return is missing; keep complete dates only"))
    unopened = F.raise_error(F.lit("a holding has no weight on the date its segment opens"))
    absent = F.raise_error(F.lit("a holding lacks a row inside its segment; keep complete dates only"))
    rows = (
        weights.select(*STRATEGY, SYMBOL, TS, "weight")
        .join(returns.select(PANEL, SYMBOL, TS, RET), [PANEL, SYMBOL, TS], "left")
        .withColumn(RET, F.coalesce(RET, missing.cast("double")))
    )
    placed = positions(rows, STRATEGY)
    holding = F.floor((F.col(POS) - 1) / every)
    opens = F.when(
        F.col(POS) % every == 0,
        F.struct((F.col(POS) / every).cast("bigint").alias("k"), F.lit(True).alias("opening")),
    )
    held = F.when(F.col(POS) > 0, F.struct(holding.alias("k"), F.lit(False).alias("opening")))
    parts = placed.select(
        "*", F.explode(F.filter(F.array(opens, held), lambda s: s.isNotNull())).alias("s")
    ).select(*STRATEGY, SYMBOL, TS, POS, "n_dates", "weight", RET, "s.k", "s.opening")

    segment = Window.partitionBy(*STRATEGY, SYMBOL, "k").orderBy(POS)
    whole = Window.partitionBy(*STRATEGY, SYMBOL, "k").orderBy(POS).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    so_far = segment.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    f = F.when(F.col("opening"), F.lit(1.0)).otherwise(1 + F.col(RET))
    size = F.exp(F.sum(F.when(f != 0, F.ln(F.abs(f))).otherwise(0.0)).over(so_far))
    sign = F.when(F.count_if(f < 0).over(so_far) % 2 == 1, -1.0).otherwise(1.0)
    growth = F.when(F.count_if(f == 0).over(so_far) > 0, 0.0).otherwise(sign * size)
    # the opening row and one for every date up to the next reset or the end
    expected = 1 + F.least(F.lit(every).cast("bigint"), F.col("n_dates") - 1 - F.col("k") * every)
    drifted = (
        parts.withColumn("w0", F.max(F.when(F.col("opening"), F.col("weight"))).over(whole))
        .withColumn("w0", F.coalesce("w0", unopened.cast("double")))
        .withColumn("w0", F.when(F.count(F.lit(1)).over(whole) == expected, F.col("w0")).otherwise(absent.cast("double")))
        .withColumn("g", growth)
        .withColumn("g_prev", F.lag("g").over(segment))
        .where(~F.col("opening"))
        .withColumn("held", F.col("w0") * F.col("g"))
        .withColumn("held_prev", F.col("w0") * F.col("g_prev"))
    )
    drifted = stage(drifted.select(*STRATEGY, TS, POS, "n_dates", "weight", "held", "held_prev"))
    sums = drifted.groupBy(*STRATEGY, TS, POS, "n_dates").agg(
        F.sum("held").alias("v"), F.sum("held_prev").alias("v_prev")
    )
    first_day = (F.col(POS) - 1) % every == 0
    resets = drifted.where(F.col(POS) % every == 0).select(
        *STRATEGY, POS, "held_prev", "weight"
    )
    base = F.when(first_day, F.lit(1.0)).otherwise(F.col("v_prev"))
    traded = (
        resets.join(sums.select(*STRATEGY, POS, "v_prev"), [*STRATEGY, POS])
        .groupBy(*STRATEGY, POS)
        .agg(F.sum(F.abs(ratio(F.col("held_prev"), base) - F.col("weight"))).alias("turnover"))
    )
    gross = F.when(first_day, F.col("v") - F.col("v_prev")).otherwise(
        ratio(F.col("v"), F.col("v_prev")) - 1
    )
    days = sums.join(traded, [*STRATEGY, POS], "left").select(
        *STRATEGY,
        TS,
        POS,
        "n_dates",
        gross.alias("portfolio_return"),
        F.coalesce("turnover", F.lit(0.0)).alias("turnover"),
        F.coalesce(F.col("turnover") * transaction_cost, F.lit(0.0)).alias("transaction_cost"),
    )
    net = (1 + F.col("portfolio_return")) * (1 - F.col("transaction_cost"))
    ledger = _running_product(stage(days), STRATEGY, {"portfolio_value": net}, block_rows)
    return stage(cumulative_return(ledger))


def cumulative_return(ledger: DataFrame) -> DataFrame:
    """Value against the first ledger value (the first day's own return is not in it)."""
    first = ledger.groupBy(*STRATEGY).agg(F.min_by("portfolio_value", POS).alias("first"))
    change = ratio(F.col("portfolio_value"), F.col("first")) - 1
    return ledger.join(first, STRATEGY).withColumn("cumulative_return", change).drop("first")


def drawdown_series(ledger: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Wealth from gross daily returns, and its distance from the running maximum."""
    wealth = _running_product(ledger, STRATEGY, {"wealth": 1 + F.col("portfolio_return")}, block_rows)
    peak = running(wealth, STRATEGY, {"peak": ("max", F.col("wealth"))}, block_rows)
    return peak.withColumn(
        "drawdown", ratio(F.col("wealth") - F.col("peak"), F.col("peak"))
    ).drop("peak")


def cumulative_wealth(ledger: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    return _running_product(
        ledger.select(*STRATEGY, TS, POS, "portfolio_return"),
        STRATEGY,
        {"wealth": 1 + F.col("portfolio_return")},
        block_rows,
    )


def rolling_sharpe(ledger: DataFrame, window: int = 252, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Annualised rolling mean over annualised rolling deviation of daily returns."""
    x, w = F.col("portfolio_return"), block_window(STRATEGY)
    mean, dev = full(x, window, w, F.avg(x)), full(x, window, w, F.stddev_samp(x))
    sharpe = ratio(mean * TRADING_DAYS, dev * F.sqrt(F.lit(float(TRADING_DAYS))))
    rows = series_blocks(
        ledger.select(*STRATEGY, TS, POS, "n_dates", "portfolio_return"), window, STRATEGY, block_rows
    )
    return core(rows.withColumn("rolling_sharpe", sharpe), window, block_rows).select(
        *STRATEGY, TS, "rolling_sharpe"
    )


def performance_metrics(ledger: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Twelve metrics, one row per strategy. Ratios without a positive denominator are 0."""
    x = F.col("portfolio_return")
    year = F.sqrt(F.lit(float(TRADING_DAYS)))
    stats = drawdown_series(ledger, block_rows).groupBy(*STRATEGY).agg(
        F.max_by("cumulative_return", POS).alias("total_return"),
        F.count(F.lit(1)).alias("_n"),
        (F.stddev_samp(x) * year).alias("annualized_volatility"),
        (F.stddev_samp(F.when(x < 0, x)) * year).alias("_downside"),
        F.min("drawdown").alias("max_drawdown"),
        (F.count_if(x > 0) / F.count(F.lit(1))).alias("win_rate"),
        F.sum("transaction_cost").alias("total_transaction_costs"),
        F.avg(x).alias("avg_daily_return"),
        sample_skew(x).alias("skewness"),
        sample_kurtosis(x).alias("kurtosis"),
    )
    grown = F.pow(1 + F.col("total_return"), TRADING_DAYS / F.col("_n")) - 1

    def per(denominator: str, size: Column) -> Column:
        usable = F.col(denominator).isNotNull() & (size > 0)
        return F.when(usable, F.col("annualized_return") / size).otherwise(0.0)

    return (
        stats.withColumn("annualized_return", grown)
        .withColumn("sharpe_ratio", per("annualized_volatility", F.col("annualized_volatility")))
        .withColumn("sortino_ratio", per("_downside", F.col("_downside")))
        .withColumn("calmar_ratio", per("max_drawdown", F.abs("max_drawdown")))
        .drop("_n", "_downside")
    )


def compare_strategies(
    weights: DataFrame, returns: DataFrame, transaction_cost: float = 0.001, every: int = 21
) -> DataFrame:
    """Metrics of constant-weight strategies; one with a missing weight is left out."""
    broken = weights.where(F.col("weight").isNull()).select(*STRATEGY).distinct()
    sound = weights.join(broken, STRATEGY, "left_anti")
    ledger = backtest(constant_weights(sound, returns), returns, transaction_cost, every)
    return performance_metrics(ledger)
