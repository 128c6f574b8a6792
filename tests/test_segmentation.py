"""Fixed numbers of changes against brute force, and joins to per-key figures."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelspark.operators import backtest, changepoint, features, regimes, segmentation
from panelspark.operators.blocks import figures, with_figures


def marginal(x):
    n, s1, s2 = len(x), x.sum(), (x * x).sum()
    a, b = 1 + n / 2, 1 + 0.5 * max(s2 - s1 * s1 / (1 + n), 0)
    return -n / 2 * math.log(2 * math.pi) + 0.5 * math.log(1 / (1 + n)) - a * math.log(b) + math.lgamma(a)


def best_of_all(x, changes, gap):
    z = (x - x.mean()) / x.std()
    n = len(z)
    own = {(i, j): marginal(z[i:j]) for i in range(n) for j in range(i + 1, n + 1)}
    allowed = range(max(1, int(n * 0.1)), int(math.floor(n * 0.9)))
    best = (-math.inf, ())
    for c in itertools.combinations(allowed, changes):
        if all(b - a >= gap for a, b in zip(c, c[1:])):
            at = (0, *c, n)
            best = max(best, (sum(own[i, j] for i, j in zip(at, at[1:])), c))
    return best


def series_of(spark, panels):
    rows = [
        (p, d.date(), float(v) if np.isfinite(v) else None)
        for p, x in panels.items() for d, v in zip(pd.date_range("2020-01-01", periods=len(x)), x)
    ]
    return spark.createDataFrame(rows, "panel_id string, ts date, x double")


@pytest.mark.parametrize("side", [16, 512])
def test_fixed_changes_are_the_best_of_all(spark, side, monkeypatch):
    monkeypatch.setattr(segmentation, "SIDE", side)
    rng = np.random.default_rng(4)
    panels = {
        "a": rng.normal(0, np.repeat([1, 3, 0.5], 20)),
        "b": np.concatenate([rng.normal(0, 1, 25), rng.normal(4, 1, 20)]),
        "short": rng.normal(0, 1, 7),
    }
    df = series_of(spark, panels | {"gap": np.where(np.arange(70) % 9 == 4, np.nan, np.concatenate([rng.normal(0, 1, 40), rng.normal(0, 5, 30)]))})
    got = segmentation.fixed_changepoints(df, "x", 3).toPandas()
    for name, x in panels.items():
        own = got[got.panel_id == name].sort_values("pos")
        value, changes = best_of_all(x, 2, max(5, len(x) // 50))
        assert own.pos[own.is_change].tolist() == list(changes)
        assert own.log_evidence.isna().all() if not changes else np.allclose(own.log_evidence, value, rtol=1e-9)
    gap = got[got.panel_id == "gap"].sort_values("pos")
    x = df.where("panel_id = 'gap' and x is not null").orderBy("ts").toPandas().x.to_numpy()
    assert gap.pos[gap.is_change].tolist() == list(best_of_all(x, 2, 5)[1])
    # the number is fixed: exactly as many as asked
    for n in (1, 2, 4):
        found = segmentation.fixed_changepoints(df.where("panel_id in ('a', 'b')"), "x", n)
        assert {r["k"] for r in found.groupBy("panel_id").agg(F.count_if("is_change").alias("k")).collect()} == {n - 1}
    assert segmentation.fixed_changepoints(df.where("false"), "x", 3).count() == 0
    with pytest.raises(ValueError):
        segmentation.fixed_changepoints(df, "x", 0)


def test_figures_reach_every_row(spark):
    rows = [(f"p{i % 3}", "s", i * 9000, float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "panel_id string, symbol string, pos long, x double")
    got = with_figures(df, figures(df, ["panel_id"], F.avg("x").alias("m")), ["panel_id"]).toPandas()
    want = got.groupby("panel_id").x.transform("mean")
    assert len(got) == 40 and np.allclose(got.m, want) and "_block" not in got.columns
    # figures without blocks, and keys that have none
    few = spark.createDataFrame([("p1", 5)], "panel_id string, v int")
    assert with_figures(df, few, ["panel_id"]).count() == 13
    assert with_figures(df, few, ["panel_id"], "left").where("v is null").count() == 27


def test_rows_are_never_dealt_by_panel_or_symbol_alone(spark):
    """Without broadcasts: every join of rows to figures is by (key, block)."""
    rows = [("p", s, d.date(), float(i % 7) if i % 5 else None) for s in "ab" for i, d in enumerate(pd.date_range("2020-01-01", periods=60))]
    df = spark.createDataFrame(rows, "panel_id string, symbol string, ts date, x double")
    ret = df.select("panel_id", "symbol", "ts", F.coalesce("x", F.lit(0.0)).alias("ret"))
    weights = spark.createDataFrame([("p", "a", "w", 1.0)], "panel_id string, symbol string, strategy string, weight double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows_only = [
            features.impute_mean(df, ["x"]),
            features.drop_incomplete(df, ["x"], "row"),
            features.fill_sparse(df, ["x"], threshold=0.1),
            regimes.standardise(ret, ["ret"]),
            changepoint.changepoint_posterior(ret.where("symbol = 'a'"), "ret"),
        ]
        # these also join a row per key to the blocks of that key
        with_small = [regimes.volatility_regimes(ret, 5), backtest.constant_weights(weights, ret)]
        for found in rows_only + with_small:
            plan = found._jdf.queryExecution().executedPlan().toString()
            joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
            assert any("_block#" in j for j in joins)
            if any(found is x for x in rows_only):
                # by block of figures, block of a scan, slice of the calendar, or date
                assert all(any(k in j for k in ("_block#", "_b#", "slice#", "ts#")) for j in joins), joins
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
