"""Portfolio construction for many problems per job.

Moments come from Spark aggregates. A problem is one row per asset (its mean, bounds, current
weight and covariance row); problems are solved in parallel, one task per group, and report a
``status`` instead of failing the job. A problem has at most a few thousand assets.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.numeric import ratio
from panelspark.operators import solvers
from panelspark.operators.blocks import positions
from panelspark.operators.market import moments_by_regime
from panelspark.schema import PANEL, POS, RET, SYMBOL, TS

PROBLEM = ("problem_id",)


def problem_rows(
    mu: DataFrame,
    cov: DataFrame,
    keys: Sequence[str] = PROBLEM,
    current: DataFrame | None = None,
    lo: float = 0.0,
    hi: float = 1.0,
) -> DataFrame:
    """One row per problem and asset, with its covariance row in symbol order.

    Columns ``lo``, ``hi`` of ``mu`` override the defaults per asset.
    """
    keys = list(keys)
    rows = cov.groupBy(*keys, F.col("sym_i").alias(SYMBOL)).agg(
        F.array_sort(F.collect_list(F.struct("sym_j", "cov"))).alias("row")
    )
    out = mu.join(rows, [*keys, SYMBOL])
    for name, value in (("lo", lo), ("hi", hi)):
        if name not in mu.columns:
            out = out.withColumn(name, F.lit(value))
    if current is not None:
        out = out.join(
            current.select(*[k for k in keys if k in current.columns], SYMBOL, F.col("weight").alias("w0")),
            [*[k for k in keys if k in current.columns], SYMBOL],
            "left",
        ).withColumn("w0", F.coalesce("w0", F.lit(0.0)))
    else:
        out = out.withColumn("w0", F.lit(None).cast("double"))
    return out.select(
        *keys, SYMBOL, "mu", "lo", "hi", "w0", F.transform("row", lambda r: r["cov"]).alias("row")
    )


def _solve(problems: DataFrame, keys: Sequence[str], kernel: Callable) -> DataFrame:
    keys = list(keys)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(SYMBOL)
        n = len(pdf)
        out = pdf[[*keys, SYMBOL]].copy()
        if any(len(r) != n for r in pdf["row"]):
            out["weight"], out["status"] = np.nan, "incomplete covariance"
        else:
            w, status = kernel(pdf, np.stack(pdf["row"].to_numpy()))
            out["weight"], out["status"] = w, status
        return out

    types = [f"{k} {problems.schema[k].dataType.simpleString()}" for k in keys]
    schema = ", ".join([*types, f"{SYMBOL} string", "weight double", "status string"])
    solved = problems.groupBy(*keys).applyInPandas(run, schema)
    return solved.withColumn("weight", F.when(F.col("status") == "optimal", F.col("weight")))


def mean_variance(
    problems: DataFrame,
    risk_aversion: float = 1.0,
    target_return: float | None = None,
    transaction_cost: float = 0.0,
    keys: Sequence[str] = PROBLEM,
) -> DataFrame:
    """max w'mu - lambda w'cov w - cost |w - w0|; without current weights there is no cost."""

    def kernel(pdf, cov):
        w0 = None if pdf["w0"].isna().all() else pdf["w0"].to_numpy(float)
        return solvers.mean_variance(
            pdf["mu"].to_numpy(float), cov, risk_aversion, pdf["lo"].to_numpy(float),
            pdf["hi"].to_numpy(float), transaction_cost, w0, target_return,
        )

    return _solve(problems, keys, kernel)


def minimum_variance(problems: DataFrame, keys: Sequence[str] = PROBLEM) -> DataFrame:
    def kernel(pdf, cov):
        scale = max(np.diag(cov).max(), 1e-300)
        return solvers.mean_variance(
            np.zeros(len(pdf)), cov / scale, 1.0, pdf["lo"].to_numpy(float), pdf["hi"].to_numpy(float)
        )

    return _solve(problems, keys, kernel)


def maximum_sharpe(
    problems: DataFrame, risk_free: float = 0.0, keys: Sequence[str] = PROBLEM
) -> DataFrame:
    def kernel(pdf, cov):
        return solvers.maximum_sharpe(
            pdf["mu"].to_numpy(float), cov, risk_free, pdf["lo"].to_numpy(float), pdf["hi"].to_numpy(float)
        )

    return _solve(problems, keys, kernel)


def optimality_gap(
    weights: DataFrame, mu: DataFrame, cov: DataFrame, objective: str = "mean_variance",
    risk_aversion: float = 1.0, keys: Sequence[str] = PROBLEM,
) -> DataFrame:
    """Per problem without upper bounds: n_assets, total weight, least weight and the optimality gap.

    On the budget, weights w are optimal exactly if no asset's slope g exceeds the held average, so
    max(g) - w'g is zero there and positive elsewhere. g is mu - 2 lambda Cov w for mean-variance, and
    mu - (mu'w / w'Cov w) Cov w for the Sharpe ratio.
    """
    if objective not in ("mean_variance", "sharpe"):
        raise ValueError(f"unknown objective: {objective}")
    keys = list(keys)
    held = weights.select(*keys, F.col(SYMBOL).alias("sym_j"), F.col("weight").alias("w_j"))
    risk = (
        cov.join(held, [*keys, "sym_j"])
        .groupBy(*keys, F.col("sym_i").alias(SYMBOL))
        .agg(F.sum(F.col("cov") * F.col("w_j")).alias("cw"))
    )
    rows = weights.select(*keys, SYMBOL, "weight").join(mu.select(*keys, SYMBOL, "mu"), [*keys, SYMBOL]).join(
        risk, [*keys, SYMBOL]
    )
    if objective == "sharpe":
        problem = Window.partitionBy(*keys)
        price = F.sum(F.col("mu") * F.col("weight")).over(problem) / F.sum(F.col("cw") * F.col("weight")).over(problem)
        rows = rows.withColumn("slope", F.col("mu") - price * F.col("cw"))
    else:
        rows = rows.withColumn("slope", F.col("mu") - 2 * risk_aversion * F.col("cw"))
    return rows.groupBy(*keys).agg(
        F.count("weight").alias("n_assets"), F.sum("weight").alias("total"), F.min("weight").alias("least"),
        (F.max("slope") - F.sum(F.col("weight") * F.col("slope"))).alias("gap"),
    )


def risk_parity(cov: DataFrame, keys: Sequence[str] = PROBLEM) -> DataFrame:
    """Inverse volatility weights."""
    vol = F.sqrt("cov")
    own = cov.where("sym_i = sym_j").select(
        *keys, F.col("sym_i").alias(SYMBOL), vol.alias("asset_volatility")
    )
    total = own.groupBy(*keys).agg(F.sum(ratio(F.lit(1.0), F.col("asset_volatility"))).alias("total"))
    return own.join(total, list(keys)).select(
        *keys,
        SYMBOL,
        (ratio(F.lit(1.0), F.col("asset_volatility")) / F.col("total")).alias("weight"),
        "asset_volatility",
    )


def _marginal(weights: DataFrame, cov: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(cov w)_i per asset of each problem."""
    other = weights.select(*keys, F.col(SYMBOL).alias("sym_j"), F.col("weight").alias("w_j"))
    return (
        cov.join(other, [*keys, "sym_j"])
        .groupBy(*keys, F.col("sym_i").alias(SYMBOL))
        .agg(F.sum(F.col("cov") * F.col("w_j")).alias("marginal"))
    )


def risk_contributions(
    weights: DataFrame, cov: DataFrame, keys: Sequence[str] = PROBLEM
) -> DataFrame:
    """w_i (cov w)_i / (w'cov w), which sums to 1."""
    both = weights.join(_marginal(weights, cov, keys), [*keys, SYMBOL]).withColumn(
        "part", F.col("weight") * F.col("marginal")
    )
    total = both.groupBy(*keys).agg(F.sum("part").alias("total"))
    return both.join(total, list(keys)).select(
        *keys, SYMBOL, ratio(F.col("part"), F.col("total")).alias("risk_contribution")
    )


def portfolio_stats(
    weights: DataFrame,
    mu: DataFrame,
    cov: DataFrame,
    risk_free: float = 0.0,
    keys: Sequence[str] = PROBLEM,
) -> DataFrame:
    """Expected return, variance, volatility and Sharpe ratio (0 without volatility)."""
    rows = weights.join(mu, [*keys, SYMBOL]).join(_marginal(weights, cov, keys), [*keys, SYMBOL])
    stats = rows.groupBy(*keys).agg(
        F.sum(F.col("weight") * F.col("mu")).alias("expected_return"),
        F.sum(F.col("weight") * F.col("marginal")).alias("variance"),
    )
    vol = F.sqrt(F.greatest("variance", F.lit(0.0)))
    sharpe = F.coalesce(ratio(F.col("expected_return") - risk_free, vol), F.lit(0.0))
    return stats.withColumn("volatility", vol).withColumn("sharpe_ratio", sharpe)


def blend_regime_moments(
    mu: DataFrame, cov: DataFrame, probs: DataFrame, keys: Sequence[str] = (PANEL,)
) -> tuple[DataFrame, DataFrame]:
    """Probability-weighted means and covariances; ``probs`` has (regime, probability)."""
    on = [k for k in keys if k in probs.columns] + ["regime"]
    p = F.col("probability")
    return (
        mu.join(probs, on).groupBy(*keys, SYMBOL).agg(F.sum(p * F.col("mu")).alias("mu")),
        cov.join(probs, on).groupBy(*keys, "sym_i", "sym_j").agg(F.sum(p * F.col("cov")).alias("cov")),
    )


def turnover_cost(
    weights: DataFrame,
    current: DataFrame,
    transaction_cost: float = 0.001,
    keys: Sequence[str] = PROBLEM,
) -> DataFrame:
    """Traded volume against current weights and what it costs."""
    now = current.select(*keys, SYMBOL, F.col("weight").alias("w0"))
    moved = F.abs(F.coalesce("weight", F.lit(0.0)) - F.coalesce("w0", F.lit(0.0)))
    return (
        weights.join(now, [*keys, SYMBOL], "full_outer")
        .groupBy(*keys)
        .agg(F.sum(moved).alias("turnover"))
        .withColumn("transaction_cost", F.col("turnover") * transaction_cost)
    )


def regime_aware_portfolio(
    returns: DataFrame,
    regimes: DataFrame,
    probs: DataFrame,
    current: DataFrame | None = None,
    transaction_cost: float = 0.001,
    risk_aversion: float = 1.0,
) -> tuple[DataFrame, DataFrame]:
    """Blend the moments of each regime, optimise, and account for turnover: weights, stats."""
    keys = [PANEL]
    mu, cov = blend_regime_moments(*moments_by_regime(returns, regimes), probs, keys)
    problems = problem_rows(mu, cov, keys, current)
    weights = mean_variance(
        problems, risk_aversion, transaction_cost=transaction_cost, keys=keys
    )
    stats = portfolio_stats(weights, mu, cov, keys=keys)
    if current is not None:
        traded = turnover_cost(weights, current, transaction_cost, keys)
        stats = stats.join(traded, keys).withColumn(
            "net_return", F.col("expected_return") - F.col("transaction_cost")
        )
    return weights, stats


def adaptive_portfolio(
    returns: DataFrame,
    regimes: DataFrame,
    lookback: int = 252,
    min_obs: int = 20,
    risk_aversion: float = 1.0,
    lag_regime: bool = False,
    dates_per_task: int = 32,
) -> DataFrame:
    """Walk-forward weights: each date uses the past rows that share its regime.

    Fewer than ``min_obs`` of them means all past rows. Dates are solved in blocks that carry
    ``lookback`` earlier rows along; ``lag_regime`` takes the regime of the date before, so
    that nothing of the date itself is used.
    """
    step = max(dates_per_task, 1)

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        start = int(pdf["task"].iloc[0]) * step
        pos, pi = np.unique(pdf[POS].to_numpy(), return_inverse=True)
        sym, si = np.unique(pdf[SYMBOL].to_numpy(dtype=str), return_inverse=True)
        x = np.full((len(pos), len(sym)), np.nan)
        x[pi, si] = pdf[RET].to_numpy(float)
        regime = np.zeros(len(pos), dtype=int)
        regime[pi] = pdf["regime"].to_numpy(int)
        out = []
        for i in range(lookback, len(pos)):
            if pos[i] < start:
                continue
            past, label = x[i - lookback : i], regime[i - 1] if lag_regime else regime[i]
            same = past[regime[i - lookback : i] == label]
            used = same if len(same) >= min_obs else past
            w, status = solvers.mean_variance(
                used.mean(axis=0), np.cov(used, rowvar=False), risk_aversion, 0.0, 1.0
            )
            if status == "optimal":
                out.append(pd.DataFrame({POS: pos[i], SYMBOL: sym, "weight": w}))
        if not out:
            return pd.DataFrame({PANEL: [], POS: [], SYMBOL: [], "weight": []}).astype(
                {PANEL: str, POS: int, SYMBOL: str, "weight": float}
            )
        found = pd.concat(out)
        found.insert(0, PANEL, pdf[PANEL].iloc[0])
        return found

    rows = returns.drop(POS, "n_dates").join(regimes.select(PANEL, TS, "regime"), [PANEL, TS])
    placed = positions(rows)
    first = F.floor(F.col(POS) / step)
    last = F.least(
        F.floor((F.col(POS) + lookback) / step), F.floor((F.col("n_dates") - 1) / step)
    )
    tasks = placed.select(
        PANEL, POS, SYMBOL, RET, "regime", F.explode(F.sequence(first, last)).alias("task")
    )
    solved = tasks.groupBy(PANEL, "task").applyInPandas(
        walk, f"{PANEL} string, {POS} long, {SYMBOL} string, weight double"
    )
    dates = placed.groupBy(PANEL, POS, TS).agg(F.lit(1).alias("one")).drop("one")
    return solved.join(dates, [PANEL, POS]).select(PANEL, TS, SYMBOL, "weight")
