"""Gaussian hidden Markov models, many panels and long sequences at once.

A sequence is cut in blocks. What a block does to the state distribution is one K x K
matrix, so a first pass reduces each block to it, a chain over one small row per block gives
every block the distribution that enters it and the message that comes back, and a second
pass works inside the blocks. Parameters are a small table with one row per panel.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.blocks import BLOCK, BLOCK_ROWS, positions, with_figures
from panelspark.operators.market import dispersion, market_return
from panelspark.operators.regimes import hmm_regime_names, kmeans_fit, standardise
from panelspark.schema import PANEL, POS, TS
from panelspark.session import release, stage

FLOOR = 1e-3  # smallest covariance eigenvalue
_PARAMS = f"{PANEL} string, pi array<double>, a array<double>, mu array<double>, cov array<double>, ll double"
_FITTED = f"{_PARAMS}, rounds int, converged boolean"
_CHAIN = f"{PANEL} string, {BLOCK} long, enter array<double>, leave array<double>"


def hmm_features(returns: DataFrame) -> DataFrame:
    """Market return and cross-sectional deviation per date."""
    both = market_return(returns).join(
        dispersion(returns).withColumnRenamed("dispersion", "volatility"), [PANEL, TS]
    )
    return both.dropna()


# --- kernels on one block -------------------------------------------------------------


def _unpack(row, k: int):
    mu = np.asarray(row["mu"]).reshape(k, -1)
    d = mu.shape[1]
    return np.asarray(row["pi"]), np.asarray(row["a"]).reshape(k, k), mu, np.asarray(row["cov"]).reshape(k, d, d)


def _log_emissions(x: np.ndarray, mu: np.ndarray, cov: np.ndarray) -> np.ndarray:
    out = np.empty((len(x), len(mu)))
    for j in range(len(mu)):
        chol = np.linalg.cholesky(cov[j])
        y = np.linalg.solve(chol, (x - mu[j]).T)
        out[:, j] = -0.5 * (y * y).sum(axis=0) - np.log(np.diag(chol)).sum()
    return out - 0.5 * x.shape[1] * np.log(2 * np.pi)


def _transfer(logs: np.ndarray, a: np.ndarray, first: bool) -> np.ndarray:
    """Effect of a block on the state distribution, scaled to sum 1."""
    e = np.exp(logs - logs.max(axis=1, keepdims=True))
    m = np.diag(e[0]) if first else a * e[0]
    for t in range(1, len(e)):
        m = (m @ a) * e[t]
        m /= m.sum()
    return m / m.sum()


def _max_transfer(logs: np.ndarray, loga: np.ndarray, first: bool) -> np.ndarray:
    """Best log score of entering a block in i and leaving it in j."""
    k = len(loga)
    m = np.where(np.eye(k) > 0, logs[0][None, :], -np.inf) if first else loga + logs[0]
    for t in range(1, len(logs)):
        m = (m[:, :, None] + loga[None]).max(axis=1) + logs[t]
    return m


def _smooth(logs, a, enter, leave, first):
    """State probabilities, expected transitions and log-likelihood of a block."""
    peak = logs.max(axis=1, keepdims=True)
    e = np.exp(logs - peak)
    n, k = e.shape
    alpha, scale = np.empty((n, k)), np.empty(n)
    v = enter
    for t in range(n):
        v = v * e[t] if (first and t == 0) else (v @ a) * e[t]
        scale[t] = v.sum()
        v = v / scale[t]
        alpha[t] = v
    beta = np.empty((n, k))
    u = leave / leave.sum()
    for t in range(n - 1, -1, -1):
        beta[t] = u
        u = a @ (e[t] * u)
        u = u / u.sum()
    gamma = alpha * beta
    gamma /= gamma.sum(axis=1, keepdims=True)
    prior = alpha[:-1] if first else np.vstack([enter, alpha[:-1]])
    after = (e * beta)[1:] if first else e * beta
    xi = prior[:, :, None] * a[None] * after[:, None, :]
    if len(xi):
        xi /= xi.sum(axis=(1, 2), keepdims=True)
    return gamma, xi.sum(axis=0) if len(xi) else np.zeros((k, k)), np.log(scale).sum() + peak.sum()


def _expected(x, first, enter, leave, a, mu, cov) -> np.ndarray:
    """What a block adds to the sums that the next parameters are made of; the log-likelihood comes last."""
    gamma, xi, ll = _smooth(_log_emissions(x, mu, cov), a, enter, leave, first)
    start = gamma[0] if first else np.zeros(len(a))
    second = np.einsum("tk,ti,tj->kij", gamma, x, x)
    return np.concatenate([start, xi.ravel(), gamma.sum(axis=0), (gamma.T @ x).ravel(), second.ravel(), [ll]])


def _maximised(v: np.ndarray, k: int, dims: int):
    """(pi, a, mu, cov) from those sums; states ordered by their mean in the last feature."""
    start, xi, n, s1, s2 = np.split(v[:-1], np.cumsum([k, k * k, k, k * dims]))
    xi, s1, s2 = xi.reshape(k, k), s1.reshape(k, dims), s2.reshape(k, dims, dims)
    n = np.maximum(n, 1e-10)
    mu = s1 / n[:, None]
    cov = s2 / n[:, None, None] - mu[:, :, None] * mu[:, None, :]
    for j in range(k):
        w, q = np.linalg.eigh(cov[j])
        cov[j] = (q * np.maximum(w, FLOOR)) @ q.T
    rows = xi.sum(axis=1, keepdims=True)
    a = np.where(rows > 0, xi / np.maximum(rows, 1e-300), 1.0 / k)
    o = np.argsort(mu[:, -1], kind="stable")
    return (start / start.sum())[o], a[np.ix_(o, o)], mu[o], cov[o]


def _best_path(logs, loga, enter, leave, first):
    """Best state path of a block between the state before it and its known last state."""
    n, k = logs.shape
    back = np.zeros((n, k), dtype=int)
    d = enter + logs[0] if first else (enter[:, None] + loga).max(axis=0) + logs[0]
    for t in range(1, n):
        s = d[:, None] + loga
        back[t] = s.argmax(axis=0)
        d = s.max(axis=0) + logs[t]
    path = np.empty(n, dtype=int)
    path[-1] = int(np.argmax(leave))
    for t in range(n - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


def _rows(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, bool]:
    pdf = pdf.sort_values(POS)
    return pdf, np.stack(pdf["x"].to_numpy()), int(pdf[POS].iloc[0]) == 0


# --- chaining blocks ------------------------------------------------------------------


def _blocked(points: DataFrame, block_rows: int) -> DataFrame:
    placed = positions(points.select(PANEL, TS, "x"))
    return stage(placed.withColumn(BLOCK, F.floor(F.col(POS) / block_rows)))


def _fresh(df: DataFrame) -> DataFrame:
    """The same columns under new identities, for joining a table with its own summary."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def _block_list(blocks: DataFrame, params: DataFrame) -> DataFrame:
    ids = blocks.groupBy(PANEL, BLOCK).agg(F.lit(1).alias("one")).drop("one")
    return _fresh(ids.join(params, PANEL))


def _chain(blocks: DataFrame, params: DataFrame, k: int, best: bool, single: bool) -> DataFrame:
    """Per block what enters it and what it is left with (log scores if ``best``)."""
    listed = _block_list(blocks, params)
    if single and not best:
        ones = F.array(*[F.lit(1.0)] * k)
        return listed.select(PANEL, BLOCK, F.col("pi").alias("enter"), ones.alias("leave"))

    def reduce(pdf: pd.DataFrame, par: pd.DataFrame) -> pd.DataFrame:
        pdf, x, first = _rows(pdf)
        _, a, mu, cov = _unpack(par.iloc[0], k)
        logs = _log_emissions(x, mu, cov)
        with np.errstate(divide="ignore"):
            m = _max_transfer(logs, np.log(a), first) if best else _transfer(logs, a, first)
        return pd.DataFrame({PANEL: par[PANEL], BLOCK: par[BLOCK], "pi": par["pi"], "m": [m.ravel()]})

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(BLOCK)
        ms = [np.asarray(m).reshape(k, k) for m in pdf["m"]]
        v, enter, leave = np.asarray(pdf["pi"].iloc[0]), [], [None] * len(ms)
        with np.errstate(divide="ignore"):
            v = np.log(v) if best else v
        for m in ms:
            enter.append(v)
            v = (v[:, None] + m).max(axis=0) if best else v @ m
            v = v - v.max() if best else v / v.sum()
        if best:
            state = int(np.argmax(v))
            for b in range(len(ms) - 1, -1, -1):
                leave[b] = np.eye(k)[state]
                state = int(np.argmax(enter[b] + ms[b][:, state]))
                if b > 0:
                    enter[b] = np.where(np.arange(k) == state, 0.0, -1e300)
        else:
            u = np.ones(k)
            for b in range(len(ms) - 1, -1, -1):
                leave[b] = u
                u = ms[b] @ u
                u = u / u.sum()
        return pd.DataFrame({PANEL: pdf[PANEL], BLOCK: pdf[BLOCK], "enter": enter, "leave": leave})

    summary = (
        blocks.groupBy(PANEL, BLOCK)
        .cogroup(listed.groupBy(PANEL, BLOCK))
        .applyInPandas(reduce, f"{PANEL} string, {BLOCK} long, pi array<double>, m array<double>")
    )
    return summary.groupBy(PANEL).applyInPandas(chain, _CHAIN)


def _inside(blocks, params, k, kernel, schema, best, single):
    chained = _fresh(_chain(blocks, params, k, best, single).join(params, PANEL))

    def run(pdf: pd.DataFrame, par: pd.DataFrame) -> pd.DataFrame:
        return kernel(*_rows(pdf), par.iloc[0])

    return (
        blocks.groupBy(PANEL, BLOCK)
        .cogroup(chained.groupBy(PANEL, BLOCK))
        .applyInPandas(run, schema)
    )


def _is_single(blocks: DataFrame) -> bool:
    """Whether every sequence is one block, so that there is nothing to chain."""
    return (blocks.agg(F.max(BLOCK)).first()[0] or 0) == 0


# --- operators ------------------------------------------------------------------------


def hmm_init(points: DataFrame, k: int, dims: int, seed: int = 42) -> DataFrame:
    """Cluster centres as means, the overall covariance, uniform start and transitions."""
    centres = kmeans_fit(points, k, dims, restarts=3, seed=seed).select(PANEL, "centres")
    overall = points.groupBy(PANEL).agg(
        F.array(
            *[
                F.covar_samp(F.col("x")[i], F.col("x")[j]) + (FLOOR if i == j else 0.0)
                for i in range(dims)
                for j in range(dims)
            ]
        ).alias("c")
    )
    flat = F.flatten(F.transform(F.array(*[F.lit(j) for j in range(k)]), lambda j: F.coalesce(F.get("centres", j), F.get("centres", F.lit(0)))))
    return centres.join(overall, PANEL).select(
        PANEL,
        F.array(*[F.lit(1.0 / k)] * k).alias("pi"),
        F.array(*[F.lit(1.0 / k)] * (k * k)).alias("a"),
        flat.alias("mu"),
        F.flatten(F.array_repeat("c", k)).alias("cov"),
        F.lit(None).cast("double").alias("ll"),
    )


def hmm_fit(
    points: DataFrame,
    k: int = 4,
    dims: int = 2,
    max_iter: int = 1_000,
    tol: float = 1e-6,
    seed: int = 42,
    block_rows: int = BLOCK_ROWS,
    history: list[float] | None = None,
) -> DataFrame:
    """Parameters per panel by expectation-maximisation; states ordered by their mean in the
    last feature. ``rounds`` says how many were used, ``converged`` whether the log-likelihood of the panel
    moved less than ``tol`` in the last one; a panel that has settled takes no part in further rounds.

    Panels of one block do their rounds inside one task each, all in one job; longer ones do a round a
    job, over their blocks. ``history`` collects the total log-likelihood of each round, for which all panels
    take the second way.
    """
    blocks = _blocked(points, block_rows)
    start = stage(hmm_init(blocks.select(PANEL, TS, "x"), k, dims, seed))
    lasts = stage(blocks.groupBy(PANEL).agg(F.max(BLOCK).alias("last")))
    if history is None:
        alone = lasts.where("last = 0").select(PANEL)
        short = _fit_alone(blocks.join(alone, PANEL), start.join(alone, PANEL), k, dims, max_iter, tol)
        long = lasts.where("last > 0").select(PANEL)
        if long.isEmpty():
            return short
        blocks, start = blocks.join(long, PANEL), start.join(long, PANEL)
    return (
        _fit_rounds(blocks, start, k, dims, max_iter, tol, history)
        if history is not None
        else short.unionByName(_fit_rounds(blocks, start, k, dims, max_iter, tol, None))
    )


def _fit_alone(blocks: DataFrame, start: DataFrame, k: int, dims: int, max_iter: int, tol: float) -> DataFrame:
    """All rounds of each panel in a task of its own."""

    def run(pdf: pd.DataFrame, par: pd.DataFrame) -> pd.DataFrame:
        _, x, first = _rows(pdf)
        pi, a, mu, cov = _unpack(par.iloc[0], k)
        before, settled, n = np.inf, False, 0
        while n < max_iter and not settled:
            v = _expected(x, first, pi, np.ones(k), a, mu, cov)
            pi, a, mu, cov = _maximised(v, k, dims)
            settled, before, n = abs(v[-1] - before) < tol, v[-1], n + 1
        return pd.DataFrame(
            {
                PANEL: [par[PANEL].iloc[0]], "pi": [pi], "a": [a.ravel()], "mu": [mu.ravel()], "cov": [cov.ravel()],
                "ll": [before], "rounds": [n], "converged": [settled],
            }
        )

    return blocks.groupBy(PANEL).cogroup(start.groupBy(PANEL)).applyInPandas(run, _FITTED)


def _fit_rounds(
    blocks: DataFrame, start: DataFrame, k: int, dims: int, max_iter: int, tol: float, history: list[float] | None
) -> DataFrame:
    """A job a round over the blocks of all panels that haven't settled."""
    size = k + k * k + k + k * dims + k * dims * dims + 1

    def expect(pdf, x, first, par) -> pd.DataFrame:
        _, a, mu, cov = _unpack(par, k)
        stats = _expected(x, first, np.asarray(par["enter"]), np.asarray(par["leave"]), a, mu, cov)
        return pd.DataFrame({PANEL: [par[PANEL]], "stats": [stats]})

    def maximise(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.zeros(size)
        v[pdf["i"].to_numpy()] = pdf["v"].to_numpy()
        pi, a, mu, cov = _maximised(v, k, dims)
        return pd.DataFrame(
            {PANEL: [pdf[PANEL].iloc[0]], "pi": [pi], "a": [a.ravel()], "mu": [mu.ravel()], "cov": [cov.ravel()], "ll": [v[-1]]}
        )

    names = [f.name for f in start.schema.fields]
    params = stage(start.select(*names, F.lit(0).alias("rounds"), F.lit(False).alias("converged")))
    for n in range(1, max_iter + 1):
        open_ = params.where("not converged").select(*names)
        stats = _inside(blocks, open_, k, expect, f"{PANEL} string, stats array<double>", False, False)
        summed = (
            stats.select(PANEL, F.posexplode("stats").alias("i", "v"))
            .groupBy(PANEL, "i")
            .agg(F.sum("v").alias("v"))
        )
        new = summed.groupBy(PANEL).applyInPandas(maximise, _PARAMS)
        step = F.coalesce(F.abs(F.col("ll") - F.col("before")), F.lit(float("inf")))
        new = new.join(params.select(PANEL, F.col("ll").alias("before")), PANEL).select(
            *names, F.lit(n).alias("rounds"), (step < tol).alias("converged")
        )
        after = stage(new.unionByName(params.where("converged")))
        release(params)
        params = after
        state = params.agg(F.min("converged"), F.sum("ll")).first()
        if history is not None:
            history.append(state[1])
        if state[0] is None or state[0]:
            break
    return params


def hmm_posteriors(
    points: DataFrame, params: DataFrame, k: int = 4, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """State probabilities of every date given the whole sequence."""
    blocks = _blocked(points, block_rows)

    def kernel(pdf, x, first, par) -> pd.DataFrame:
        _, a, mu, cov = _unpack(par, k)
        gamma, _, _ = _smooth(
            _log_emissions(x, mu, cov), a, np.asarray(par["enter"]), np.asarray(par["leave"]), first
        )
        return pd.DataFrame({PANEL: pdf[PANEL], POS: pdf[POS], "probs": list(gamma)})

    out = _inside(
        blocks, params, k, kernel, f"{PANEL} string, {POS} long, probs array<double>", False, _is_single(blocks)
    )
    return out.join(blocks.select(PANEL, POS, TS), [PANEL, POS]).select(PANEL, TS, "probs")


def hmm_viterbi(
    points: DataFrame, params: DataFrame, k: int = 4, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Most likely state path."""
    blocks = _blocked(points, block_rows)

    def kernel(pdf, x, first, par) -> pd.DataFrame:
        _, a, mu, cov = _unpack(par, k)
        with np.errstate(divide="ignore"):
            path = _best_path(
                _log_emissions(x, mu, cov), np.log(a), np.asarray(par["enter"]), np.asarray(par["leave"]), first
            )
        return pd.DataFrame({PANEL: pdf[PANEL], POS: pdf[POS], "regime": path})

    out = _inside(blocks, params, k, kernel, f"{PANEL} string, {POS} long, regime int", True, False)
    return out.join(blocks.select(PANEL, POS, TS), [PANEL, POS]).select(PANEL, TS, "regime")


def hmm_log_likelihood(
    points: DataFrame, params: DataFrame, k: int = 4, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Log-likelihood of each panel's sequence: the sum over its blocks."""
    blocks = _blocked(points, block_rows)

    def kernel(pdf, x, first, par) -> pd.DataFrame:
        _, a, mu, cov = _unpack(par, k)
        _, _, ll = _smooth(
            _log_emissions(x, mu, cov), a, np.asarray(par["enter"]), np.asarray(par["leave"]), first
        )
        return pd.DataFrame({PANEL: [par[PANEL]], "ll": [ll], "n": [len(x)]})

    out = _inside(blocks, params, k, kernel, f"{PANEL} string, ll double, n long", False, _is_single(blocks))
    return out.groupBy(PANEL).agg(F.sum("ll").alias("log_likelihood"), F.sum("n").alias("n_dates"))


def vectors(features: DataFrame, columns: Sequence[str] = ("market_return", "volatility")) -> DataFrame:
    """Standardised features as one vector per date."""
    return standardise(features.select(PANEL, TS, *columns), columns).select(
        PANEL, TS, F.array(*columns).alias("x")
    )


def hmm_regimes(returns: DataFrame, k: int = 4, max_iter: int = 1_000, tol: float = 1e-6) -> DataFrame:
    """Fit, decode, name; features are kept beside the labels."""
    features = stage(hmm_features(returns))
    points = stage(vectors(features))
    params = stage(hmm_fit(points, k, 2, max_iter, tol))
    found = (
        hmm_viterbi(points, params, k)
        .join(hmm_posteriors(points, params, k), [PANEL, TS])
        .join(features, [PANEL, TS])
    )
    labelled = stage(found)
    settled = params.select(PANEL, "rounds", "converged")
    named = labelled.join(hmm_regime_names(labelled), [PANEL, "regime"])
    return with_figures(named, settled, [PANEL]).select(
        PANEL, TS, "regime", "regime_name", "probs", "market_return", "volatility", "rounds", "converged"
    )
