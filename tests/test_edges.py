"""Cases the test tables don't reach: long gaps, block edges, late symbols, zero prices, absent rows."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.operators import backtest, features, indicators, market, quality, regimes
from panelspark.sources.readers import read_wide_panel

DAY = dt.date(2000, 1, 1)


def bars(spark, prices, symbol="A", panel="p"):
    rows = [(panel, symbol, DAY + dt.timedelta(days=int(i)), float(v)) for i, v in prices]
    return spark.createDataFrame(rows, "panel_id string, symbol string, ts date, price double")


def test_averages_after_a_long_gap(spark):
    """5,000 dates without a price: nothing of the past is left, and every value is finite."""
    full = bars(spark, [(i, 50.0) for i in range(5100)], "B")
    gap = bars(spark, [(i, 100.0 + i) for i in (*range(40), *range(5040, 5100))])
    both = full.unionByName(gap)
    for df in (indicators.ema(both), indicators.macd(both)):
        names = [c for c in df.columns if c.startswith(("ema", "macd"))]
        got = df.where("symbol = 'A'").select("ts", *names).toPandas().sort_values("ts")
        assert np.isfinite(got[names].to_numpy(float)).all()
    first = indicators.ema(both).where(F.col("ts") == DAY + dt.timedelta(days=5040)).where("symbol = 'A'").first()
    assert first.ema_12 == pytest.approx(100.0 + 5040)
    ohlc = both.withColumns({"high": F.col("price") + 1, "low": F.col("price") - 1})
    atr = indicators.atr(ohlc, 14).where("symbol = 'A'").select("atr_14").toPandas()["atr_14"]
    assert np.isfinite(atr.dropna()).all()


def test_correlation_with_a_late_symbol(spark):
    rng = np.random.default_rng(1)
    rows = [
        ("p", f"S{s}", DAY + dt.timedelta(days=i), float(rng.normal()))
        for s in range(3) for i in range(20 if s == 2 else 0, 60)
    ]
    df = spark.createDataFrame(rows, "panel_id string, symbol string, ts date, ret double")
    got = [
        [r.correlation for r in market.avg_pairwise_correlation(df, 5, block_rows=b).orderBy("ts").collect()]
        for b in (4096, 10)
    ]
    assert got[0] == pytest.approx(got[1], nan_ok=True)
    assert all(v is None for v in got[0][:25]) and all(v is not None for v in got[0][25:])


def test_lag_after_dates_were_dropped(spark):
    df = bars(spark, [(i, 10.0 + i) for i in range(6)]).withColumn("x", F.when(F.col("price") != 12, F.col("price")))
    kept = features.drop_incomplete(indicators.positions(df), ["x"])
    got = features.lag_features(kept, ["x"], [1]).orderBy("ts").collect()
    assert [r.x_lag_1 for r in got] == [None, 10.0, 11.0, 13.0, 14.0]


def weights_and_returns(spark):
    rows = [("p", s, DAY + dt.timedelta(days=i), 0.01 * (i % 3)) for s in "AB" for i in range(12)]
    returns = spark.createDataFrame(rows, "panel_id string, symbol string, ts date, ret double")
    weights = spark.createDataFrame([("p", s, "w", 0.5) for s in "AB"], "panel_id string, symbol string, strategy string, weight double")
    return backtest.constant_weights(weights, returns), returns


@pytest.mark.parametrize("day", [4, 5, 7])
def test_backtest_refuses_an_absent_row(spark, day):
    weights, returns = weights_and_returns(spark)
    assert backtest.backtest(weights, returns, every=5).count() == 11
    hole = (F.col("symbol") == "B") & (F.col("ts") == DAY + dt.timedelta(days=day))
    for w, r in ((weights, returns.where(~hole)), (weights.where(~hole), returns), (weights.where(~hole), returns.where(~hole))):
        with pytest.raises(Exception, match="missing|weight|lacks"):
            backtest.backtest(w, r, every=5).collect()


def test_jump_from_zero_is_extreme(spark):
    df = bars(spark, enumerate([1.0, 0.0, 5.0, 5.0]))
    assert quality.extreme_return_check(df).first().n_extreme == 2
    many = [bars(spark, enumerate([1.0, 0.0, 5.0]), f"S{k}", p) for p in "pq" for k in range(8)]
    df = many[0]
    for m in many[1:]:
        df = df.unionByName(m)
    assert quality.validation_issues(df).count() == 32
    short = quality.validation_issues(df, show=3).groupBy("panel_id").count().collect()
    assert sorted((r.panel_id, r["count"]) for r in short) == [("p", 3), ("q", 3)]


def test_times_of_day_survive_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ts,A\n2020-01-02 09:30:00,1\n2020-01-02 09:31:00,2\n")
    (tmp_path / "b.csv").write_text("ts,A\n2020-01-02 00:00:00,1\n2020-01-03,2\n")
    timed, dated = (read_wide_panel(spark, str(tmp_path / f)) for f in ("a.csv", "b.csv"))
    assert dict(timed.dtypes)["ts"] == "timestamp_ntz" and timed.select("ts").distinct().count() == 2
    assert dict(dated.dtypes)["ts"] == "date"


@pytest.mark.parametrize("k, dims", [(4, 3), (14, 5), (10, 64)])
def test_probabilities_for_absent_centres(spark, k, dims):
    """Two centres of k, whatever the size: k probabilities, those of absent centres NULL."""
    points = spark.createDataFrame([("p", 1, [0.0] * dims)], "panel_id string, ts int, x array<double>")
    centres = spark.createDataFrame([("p", [[0.0] * dims, [1.0] * dims])], "panel_id string, centres array<array<double>>")
    got = regimes.unpack_probs(regimes.assign_clusters(points, centres, k, dims), k).first()
    assert got.regime == 0 and got[f"prob_regime_{k - 1}"] is None and got.prob_regime_0 > 0.99
