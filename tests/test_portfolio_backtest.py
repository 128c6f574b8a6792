"""Optimality of portfolios and the closed-form backtest against a plain loop."""

import numpy as np
import pandas as pd
import pytest
from conftest import to_frame
from pyspark.sql import functions as F

from panelspark.operators import backtest, market, portfolio, regimes, solvers


@pytest.fixture(scope="module")
def moments(complete):
    r, df = complete
    one = df.where("panel_id = 'p'")
    rename = lambda d: d.withColumnRenamed("panel_id", "problem_id")
    return r, rename(market.mean_returns(one)).cache(), rename(market.covariance(one)).cache()


def weights_of(df):
    return df.orderBy("symbol").toPandas().set_index("symbol")["weight"]


def test_minimum_variance_beats_random(moments):
    r, mu, cov = moments
    w = weights_of(portfolio.minimum_variance(portfolio.problem_rows(mu, cov)))
    assert abs(w.sum() - 1) < 1e-12 and (w >= 0).all()
    c = r.cov().to_numpy()
    tries = np.random.default_rng(0).dirichlet(np.ones(5), 2_000)
    assert w @ c @ w <= np.einsum("ki,ij,kj->k", tries, c, tries).min() + 1e-15
    grad = c @ w
    free = w > 1e-9
    assert np.ptp(grad[free]) < 1e-10 * abs(grad).max() and (grad[~free] >= grad[free].max() - 1e-12).all()


def test_mean_variance_options(moments):
    r, mu, cov = moments
    bounded = weights_of(portfolio.mean_variance(portfolio.problem_rows(mu, cov, lo=0.05, hi=0.4), 10.0))
    assert bounded.min() >= 0.05 - 1e-12 and bounded.max() <= 0.4 + 1e-12
    goal = float(r.mean().sort_values().iloc[-2])
    w = weights_of(portfolio.mean_variance(portfolio.problem_rows(mu, cov), 500.0, target_return=goal))
    assert w @ r.mean() >= goal - 1e-10
    status = portfolio.mean_variance(portfolio.problem_rows(mu, cov, hi=0.1), 1.0)
    assert {x.status for x in status.collect()} == {"infeasible"}
    assert status.where("weight is not null").count() == 0


def test_costs_keep_weights(moments):
    r, mu, cov = moments
    now = mu.select("problem_id", "symbol", F.lit(0.2).alias("weight"))
    problems = portfolio.problem_rows(mu, cov, current=now)
    dear = weights_of(portfolio.mean_variance(problems, 1.0, transaction_cost=1.0))
    np.testing.assert_allclose(dear, 0.2)
    cost = 0.0005
    w = weights_of(portfolio.mean_variance(problems, 5.0, transaction_cost=cost))
    m, c = r.mean().to_numpy(), r.cov().to_numpy()
    value = lambda v: v @ m - 5 * v @ c @ v - cost * np.abs(v - 0.2).sum()
    tries = np.random.default_rng(0).dirichlet(np.ones(5), 3_000)
    assert value(w.to_numpy()) >= max(value(v) for v in tries) - 1e-12


def test_maximum_sharpe_and_stats(moments):
    r, mu, cov = moments
    found = portfolio.maximum_sharpe(portfolio.problem_rows(mu, cov)).cache()
    w = weights_of(found)
    m, c = r.mean().to_numpy(), r.cov().to_numpy()
    sharpe = lambda v: v @ m / np.sqrt(v @ c @ v)
    tries = np.random.default_rng(0).dirichlet(np.ones(5), 3_000)
    if (m > 0).any():
        assert sharpe(w.to_numpy()) >= max(sharpe(v) for v in tries) - 1e-12
        stats = portfolio.portfolio_stats(found, mu, cov).first()
        assert abs(stats.sharpe_ratio - sharpe(w.to_numpy())) < 1e-10


def test_many_problems_at_once(moments):
    _, mu, cov = moments
    ids = F.explode(F.expr("transform(sequence(1, 20), i -> string(i))"))
    many = lambda d: d.withColumn("problem_id", ids)
    solved = portfolio.minimum_variance(portfolio.problem_rows(many(mu), many(cov))).cache()
    assert solved.count() == 100
    spread = solved.groupBy("symbol").agg((F.max("weight") - F.min("weight")).alias("d"))
    assert spread.agg(F.max("d")).first()[0] < 1e-12


def test_risk_parity(moments):
    r, _, cov = moments
    found = portfolio.risk_parity(cov).cache()
    np.testing.assert_allclose(weights_of(found), (1 / r.std()) / (1 / r.std()).sum())
    parts = portfolio.risk_contributions(found, cov).toPandas()["risk_contribution"]
    assert abs(parts.sum() - 1) < 1e-12 and parts.max() / parts.min() < 3


def test_regime_aware(complete):
    r, df = complete
    labels = regimes.sign_regimes(df)
    probs = regimes.regime_frequencies(labels).select("panel_id", "regime", "probability")
    now = df.select("panel_id", "symbol").distinct().withColumn("weight", F.lit(0.2))
    w, stats = portfolio.regime_aware_portfolio(df, labels, probs, now)
    total = w.groupBy("panel_id").agg(F.sum("weight").alias("s")).collect()
    assert len(total) == 2 and all(abs(x.s - 1) < 1e-9 for x in total)
    s = stats.where("panel_id = 'p'").first()
    assert abs(s.net_return - (s.expected_return - 0.001 * s.turnover)) < 1e-12


def test_adaptive_matches_loop(complete):
    r, df = complete
    one = df.where("panel_id = 'p'")
    labels = regimes.sign_regimes(one)
    got = portfolio.adaptive_portfolio(one, labels, lookback=100, dates_per_task=7, risk_aversion=5.0)
    got = got.toPandas().pivot(index="ts", columns="symbol", values="weight").sort_index()
    up = (r.mean(axis=1) > 0).to_numpy()
    assert len(got) == len(r) - 100
    for t in (100, 133, 249):
        past = r.iloc[t - 100 : t]
        used = past[up[t - 100 : t] == up[t]]
        used = used if len(used) >= 20 else past
        w, _ = solvers.mean_variance(used.mean().to_numpy(), used.cov().to_numpy(), 5.0, 0.0, 1.0)
        np.testing.assert_allclose(got.iloc[t - 100], w, atol=1e-6)


def plain_backtest(weights, returns, cost, every):
    value, w, rows = 1.0, weights.iloc[0].to_numpy(), []
    for t in range(1, len(returns)):
        r = returns.iloc[t].to_numpy()
        gain = (w * r).sum()
        value *= 1 + gain
        turnover = 0.0
        if t % every == 0:
            turnover = np.abs(w - weights.iloc[t].to_numpy()).sum()
            value *= 1 - cost * turnover
            w = weights.iloc[t].to_numpy()
        else:
            w = w * (1 + r)
            w = w / w.sum()
        rows.append((value, gain, turnover))
    return pd.DataFrame(rows, index=returns.index[1:], columns=["value", "gain", "turnover"])


@pytest.mark.parametrize("every,rows", [(21, 16_384), (7, 20), (1, 16_384)])
def test_backtest_with_changing_weights(spark, complete, every, rows):
    r, df = complete
    one = df.where("panel_id = 'p'")
    w = pd.DataFrame(np.random.default_rng(5).dirichlet(np.ones(5), len(r)), index=r.index, columns=r.columns)
    target = to_frame(spark, w, "weight").where("panel_id = 'p'").withColumn("strategy", F.lit("s"))
    got = backtest.backtest(target, one, 0.002, every, rows).orderBy("ts").toPandas()
    want = plain_backtest(w, r, 0.002, every)
    np.testing.assert_allclose(got["portfolio_value"], want["value"], rtol=1e-11)
    np.testing.assert_allclose(got["portfolio_return"], want["gain"], atol=1e-13)
    np.testing.assert_allclose(got["turnover"], want["turnover"], atol=1e-12)
    np.testing.assert_allclose(got["cumulative_return"], want["value"] / want["value"].iloc[0] - 1, atol=1e-11)


def test_total_loss(spark):
    r = pd.DataFrame({"A": [0.0, 0.1, -1.0, 0.5, 0.5]}, index=pd.date_range("2020-01-01", periods=5))
    df = to_frame(spark, r, "ret").where("panel_id = 'p'")
    w = df.select("panel_id", "symbol", "ts", F.lit(1.0).alias("weight"), F.lit("s").alias("strategy"))
    value = backtest.backtest(w, df, 0.0, 21).orderBy("ts").toPandas()["portfolio_value"]
    assert value.iloc[0] == pytest.approx(1.1) and value.iloc[1] == 0.0


def test_metrics(complete):
    r, df = complete
    one = df.where("panel_id = 'p'")
    w = one.select("panel_id", "symbol").distinct().select("*", F.lit("s").alias("strategy"), F.lit(0.2).alias("weight"))
    ledger = backtest.backtest(backtest.constant_weights(w, one), one)
    got = backtest.performance_metrics(ledger).first()
    g = ledger.orderBy("ts").toPandas()["portfolio_return"]
    wealth = (1 + g).cumprod()
    assert got.max_drawdown == pytest.approx((wealth / wealth.cummax() - 1).min())
    assert got.annualized_volatility == pytest.approx(g.std() * np.sqrt(252))
    assert got.skewness == pytest.approx(g.skew()) and got.kurtosis == pytest.approx(g.kurt())
    assert got.win_rate == pytest.approx((g > 0).mean())
    short = backtest.rolling_sharpe(ledger, 50, 60).orderBy("ts").toPandas()["rolling_sharpe"]
    want = g.rolling(50).mean() * 252 / (g.rolling(50).std() * np.sqrt(252))
    np.testing.assert_allclose(short.astype(float), want, equal_nan=True)
