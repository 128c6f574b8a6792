"""Market series, moments, regimes, hidden Markov models and changepoints."""

import math

import numpy as np
import pandas as pd
import pytest
from conftest import to_frame
from pyspark.sql import functions as F

from panelspark.operators import changepoint, hmm, market, regimes


def series(df, column, panel="p"):
    got = df.where(f"panel_id = '{panel}'").select("ts", column).toPandas().set_index("ts")[column]
    got.index = pd.to_datetime(got.index)
    return got.sort_index()


def test_market_series(complete):
    r, df = complete
    np.testing.assert_allclose(series(market.market_return(df), "market_return"), r.mean(axis=1))
    np.testing.assert_allclose(series(market.dispersion(df), "dispersion"), r.std(axis=1))
    vol = (r.rolling(21).std() * np.sqrt(252)).mean(axis=1)
    for rows in (16_384, 30):
        got = series(market.market_volatility(df, 21, rows), "volatility")
        np.testing.assert_allclose(got, vol, equal_nan=True)


@pytest.mark.parametrize("tile,rows", [(256, 4_096), (2, 60)])
def test_pairwise_correlation(complete, tile, rows):
    r, df = complete
    want = [np.nan] * 60
    for i in range(60, len(r)):
        c = r.iloc[i - 60 : i].corr().to_numpy()
        want.append(c[~np.eye(len(c), dtype=bool)].mean())
    got = series(market.avg_pairwise_correlation(df, 60, tile, rows), "correlation")
    np.testing.assert_allclose(got.astype(float), want, equal_nan=True)


@pytest.mark.parametrize("sizes", [{}, {"tile": 2, "chunk": 50}])
def test_pairwise_complete_moments(spark, complete, sizes):
    r, _ = complete
    holes = r.mask(np.random.default_rng(1).random(r.shape) < 0.2)
    df = to_frame(spark, holes, "ret")
    for frame, name, want in (
        (market.covariance(df, **sizes), "cov", holes.cov()),
        (market.correlation(df, **sizes), "corr", holes.corr()),
    ):
        got = frame.where("panel_id = 'p'").toPandas().pivot(index="sym_i", columns="sym_j", values=name)
        np.testing.assert_allclose(got.to_numpy(), want.to_numpy(), rtol=1e-10)


def test_volatility_regimes(complete):
    r, df = complete
    found = regimes.volatility_regimes(df).cache()
    vol = (r.rolling(21).std() * np.sqrt(252)).mean(axis=1)
    q = vol.quantile([0.25, 0.5, 0.75]).to_numpy()
    want = np.where(vol > q[2], 3, np.where(vol > q[1], 2, np.where(vol <= q[0], 0, 1)))
    assert (series(found, "regime").to_numpy() == want).all()
    assert found.where("abs(aggregate(probs, 0D, (s, x) -> s + x) - 1) > 1e-12").count() == 0
    rows = regimes.transition_matrix(found).groupBy("panel_id", "from_regime").agg(F.sum("probability").alias("s"))
    assert all(abs(x.s - 1) < 1e-9 or x.s == 0 for x in rows.collect())
    runs = regimes.mean_run_length(found).where("panel_id = 'p'").first()
    assert runs.mean_length > 2
    turns = int((np.diff(want) != 0).sum()) + 1
    assert runs.n_runs == turns


def test_characteristics(complete):
    r, df = complete
    labels = regimes.sign_regimes(df)
    got = regimes.regime_characteristics(labels, df).where("panel_id = 'p'").toPandas().set_index("regime")
    m = r.mean(axis=1)
    for k, part in m.groupby((m > 0).astype(int)):
        assert got.loc[k, "n_days"] == len(part)
        np.testing.assert_allclose(
            got.loc[k, ["mean_return", "volatility", "skewness", "kurtosis"]].astype(float),
            [part.mean(), part.std() * np.sqrt(252), part.skew(), part.kurt()],
        )


def test_clustering(complete):
    _, df = complete
    found = regimes.returns_clustering(df.where("panel_id = 'p'"), restarts=3, max_iter=10).cache()
    assert found.select("regime").distinct().count() == 4
    assert found.where("abs(aggregate(probs, 0D, (s, x) -> s + x) - 1) > 1e-9").count() == 0
    level = found.groupBy("regime").agg(F.avg("volatility").alias("v")).orderBy("regime").toPandas()["v"]
    assert level.is_monotonic_increasing
    top = found.select(F.array_position("probs", F.array_max("probs")).alias("j"), "regime")
    assert top.where("j - 1 <> regime").count() == 0


def test_pca(spark):
    x = np.random.default_rng(3).normal(0, [3, 2, 1, 0.5], (200, 4))
    df = spark.createDataFrame([("p", i, [float(v) for v in row]) for i, row in enumerate(x)], "panel_id string, ts int, x array<double>")
    model = regimes.pca_fit(df, 2).orderBy("component").toPandas()
    values = np.linalg.eigvalsh(np.cov(x, rowvar=False, bias=True))[::-1]
    np.testing.assert_allclose(model["explained"], values[:2] / values.sum())
    proj = np.stack(regimes.pca_project(df, regimes.pca_fit(df, 2)).orderBy("ts").toPandas()["x"].to_numpy())
    np.testing.assert_allclose(proj.var(axis=0), values[:2])


@pytest.fixture(scope="module")
def switching(spark):
    rng, rows = np.random.default_rng(0), []
    for panel in ("p", "q"):
        s = 0
        for t in range(240):
            s = 1 - s if rng.random() < 0.05 else s
            x = [float(rng.normal([1, -1][s], [0.5, 1.5][s])), float(rng.normal([0, 2][s], 0.7))]
            rows.append((panel, t, x, s))
    df = spark.createDataFrame(rows, "panel_id string, t int, x array<double>, s int")
    return df.select("panel_id", F.date_add(F.lit("2020-01-01").cast("date"), F.col("t")).alias("ts"), "x", "s").cache()


def test_hmm(switching):
    history: list[float] = []
    params = hmm.hmm_fit(switching, 2, 2, 4, history=history).cache()
    assert all(b >= a - 1e-9 for a, b in zip(history, history[1:]))

    # one panel, by plain recursions over the whole sequence
    row = params.where("panel_id = 'p'").first()
    x = np.stack(switching.where("panel_id = 'p'").orderBy("ts").toPandas()["x"].to_numpy())
    a, pi = np.array(row.a).reshape(2, 2), np.array(row.pi)
    mu, cov = np.array(row.mu).reshape(2, 2), np.array(row.cov).reshape(2, 2, 2)
    e = np.empty((len(x), 2))
    for j in range(2):
        d = x - mu[j]
        e[:, j] = np.exp(-0.5 * np.einsum("ti,ij,tj->t", d, np.linalg.inv(cov[j]), d)) / (2 * np.pi * np.sqrt(np.linalg.det(cov[j])))
    v, ll, alpha = pi, 0.0, []
    for t in range(len(x)):
        v = (v if t == 0 else v @ a) * e[t]
        ll, v = ll + np.log(v.sum()), v / v.sum()
        alpha.append(v)
    u, beta = np.ones(2), [np.ones(2)]
    for t in range(len(x) - 1, 0, -1):
        u = a @ (e[t] * u)
        u = u / u.sum()
        beta.insert(0, u)
    gamma = np.array(alpha) * np.array(beta)
    gamma /= gamma.sum(axis=1, keepdims=True)
    d, back = np.log(pi) + np.log(e[0]), []
    for t in range(1, len(x)):
        s = d[:, None] + np.log(a)
        back.append(s.argmax(axis=0))
        d = s.max(axis=0) + np.log(e[t])
    path = [int(d.argmax())]
    for b in reversed(back):
        path.insert(0, int(b[path[0]]))

    for rows in (16_384, 50):
        got = hmm.hmm_log_likelihood(switching, params, 2, rows).where("panel_id = 'p'").first()
        assert abs(got.log_likelihood - ll) < 1e-8
        states = hmm.hmm_viterbi(switching, params, 2, rows).where("panel_id = 'p'").orderBy("ts").toPandas()
        assert states["regime"].tolist() == path
        probs = hmm.hmm_posteriors(switching, params, 2, rows).where("panel_id = 'p'").orderBy("ts").toPandas()
        np.testing.assert_allclose(np.stack(probs["probs"].to_numpy()), gamma, atol=1e-10)


def test_hmm_rounds_in_one_task_and_over_blocks_agree(switching):
    short = switching.where("panel_id = 'p' or ts < '2020-04-20'")
    alone = {r.panel_id: r for r in hmm.hmm_fit(short, 2, 2).collect()}
    # blocks of 100 dates: a job a round for these panels
    spread = {r.panel_id: r for r in hmm.hmm_fit(short, 2, 2, max_iter=6, block_rows=100).collect()}
    for panel, row in spread.items():
        assert alone[panel].converged and 1 < alone[panel].rounds < 1_000
        assert row.rounds == 6 and not row.converged and row.ll <= alone[panel].ll + 1e-6
    few = {r.panel_id: r for r in hmm.hmm_fit(short, 2, 2, max_iter=6).collect()}
    for panel, row in few.items():
        assert row.rounds == 6 and not row.converged
        for name in ("pi", "a", "mu", "cov"):
            np.testing.assert_allclose(getattr(row, name), getattr(spread[panel], name), rtol=1e-7, atol=1e-9)


def test_kmeans_says_whether_it_settled(switching):
    done = regimes.kmeans_fit(switching, 2, 2, restarts=2).collect()
    cut = regimes.kmeans_fit(switching, 2, 2, restarts=2, max_iter=1).collect()
    assert all(r.converged and r.rounds < 50 for r in done)
    assert all(not r.converged and r.rounds == 1 for r in cut)


def test_kmeans_rounds_send_sums_per_stretch(spark):
    """A round of one panel is a few rows a stretch, not a row per point and restart, and they are the plain sums."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 2))
    rows = [("p", i, [float(a), float(b)]) for i, (a, b) in enumerate(x)]
    rows += [("p", 900, [None, 1.0]), ("p", 901, None), ("q", 0, [1.0, 2.0]), ("q", 1, [1.0, 2.0]), (None, 2, [0.0, 0.0])]
    points = spark.createDataFrame(rows, "panel_id string, ts int, x array<double>").repartition(4)
    starts = [[x[0].tolist(), x[1].tolist(), x[2].tolist()], [x[3].tolist(), x[4].tolist(), None]]
    centres = spark.createDataFrame([("p", r, c) for r, c in enumerate(starts)], "panel_id string, r int, centres array<array<double>>")
    sent = regimes._nearest_sums(regimes._stretches(points, 2), centres, 3, 2).toPandas()
    assert len(sent) <= 4 * 5
    for r, some in enumerate(starts):
        c = np.array([v for v in some if v])
        d = np.sqrt(((x[:, None] - c) ** 2).sum(2))
        near = d.argmin(1)
        own = sent[sent["r"] == r]
        assert np.isclose(own["inertia"].sum(), (d.min(1) ** 2).sum())
        for j, part in own.groupby("j"):
            assert part["n"].sum() == (near == j).sum()
            np.testing.assert_allclose(np.sum(part["total"].tolist(), axis=0), x[near == j].sum(0))
    fitted = {r.panel_id: r for r in regimes.kmeans_fit(points, 3, 2, restarts=3).collect()}
    assert set(fitted) == {"p", "q"} and all(r.converged for r in fitted.values())
    c = np.array(fitted["p"].centres)
    near = ((x[:, None] - c) ** 2).sum(2).argmin(1)
    np.testing.assert_allclose(c, [x[near == j].mean(0) for j in range(3)], atol=1e-4)


def test_changepoints(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 1, 120), rng.normal(0, 4, 120), rng.normal(5, 1, 80)])
    rows = [("p", i, float(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "panel_id string, t int, v double").withColumn(
        "ts", F.date_add(F.lit("2020-01-01").cast("date"), F.col("t"))
    )
    found = changepoint.changepoints(df, "v").where("is_change").orderBy("pos").toPandas()["pos"]
    assert len(found) == 2 and abs(found[0] - 120) <= 3 and abs(found[1] - 240) <= 3
    posterior = changepoint.changepoint_posterior(df, "v")
    assert abs(posterior.agg(F.sum("probability")).first()[0] - 1) < 1e-9
    labels = changepoint.changepoint_regimes(df, "v", 2).groupBy("regime").count().toPandas()
    assert labels["count"].sum() == 320 and set(labels["regime"]) == {0, 1}
    gamma = spark.range(1, 60).select((F.col("id") / 4).alias("x")).withColumn("l", changepoint.ln_gamma("x")).collect()
    assert max(abs(math.lgamma(g.x) - g.l) for g in gamma) < 1e-10
