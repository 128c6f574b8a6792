"""Shaping, quality, features and imputation against pandas."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import same, to_wide
from pandas.tseries.holiday import USFederalHolidayCalendar
from pyspark.sql import functions as F

from panelspark.functions.calendar import is_federal_holiday
from panelspark.operators import blocks, features, quality, shape


@pytest.mark.parametrize("rows", [16_384, 16])
def test_dense_grid_and_filling(bars, prices, rows):
    dense = shape.densify(bars, block_rows=rows).cache()
    assert dense.where("panel_id = 'p'").count() == prices.size
    same(to_wide(dense, "price", prices), prices)
    filled = features.impute_ffill(dense, ["price"], rows)
    same(to_wide(filled, "price", prices), prices.ffill().bfill())
    line = features.impute_interpolate(dense, ["price"], rows)
    same(to_wide(line, "price", prices), prices.interpolate(limit_direction="both"))
    lagged = features.lag_features(dense, ["price", "unknown"], [1, 5], block_rows=rows)
    same(to_wide(lagged, "price_lag_5", prices), prices.shift(5))


def test_mean_median(bars, prices):
    dense = shape.densify(bars)
    same(to_wide(features.impute_mean(dense, ["price"]), "price", prices), prices.fillna(prices.mean()))
    same(to_wide(features.impute_median(dense, ["price"]), "price", prices), prices.fillna(prices.median()))


def test_cross_section(bars, prices):
    tied = bars.withColumn("price", F.round("price", 0))
    want = prices.round(0)
    got = features.cross_sectional(tied, "price").cache()
    same(to_wide(got, "price_rank", prices), want.rank(axis=1, pct=True))
    same(to_wide(got, "price_zscore", prices), want.sub(want.mean(axis=1), axis=0).div(want.std(axis=1), axis=0).replace([np.inf, -np.inf], np.nan))
    same(to_wide(got, "price_dev_mean", prices), want.sub(want.mean(axis=1), axis=0))


def test_ranks_split_in_ranges(bars, prices):
    """Groups cut in ranges rank exactly as whole ones do."""
    whole = blocks.value_ranks(bars, ["panel_id"], "price").toPandas()
    cut = blocks.value_ranks(bars, ["panel_id"], "price", range_rows=10, ranges=7).toPandas()
    key = ["panel_id", "price"]
    pd.testing.assert_frame_equal(
        whole.sort_values(key).reset_index(drop=True), cut.sort_values(key).reset_index(drop=True)
    )
    q = blocks.quantiles(bars, ["panel_id", "symbol"], "price", {"a": 0.25, "b": 0.9}, range_rows=5)
    got = q.where("panel_id = 'p'").toPandas().set_index("symbol").sort_index()
    np.testing.assert_allclose(got["a"], prices.quantile(0.25), rtol=1e-12)
    np.testing.assert_allclose(got["b"], prices.quantile(0.9), rtol=1e-12)


def test_hot_symbol(spark):
    """One symbol with most rows: many blocks, same result."""
    n = 1_200
    hot = spark.range(n).select(F.lit("HOT").alias("symbol"), F.col("id"))
    cold = spark.range(0, n, 97).select(F.lit("COLD").alias("symbol"), F.col("id"))
    bars = hot.union(cold).select(
        F.lit("p").alias("panel_id"), "symbol",
        F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).alias("ts"),
        (F.col("id") % 13 + 1).cast("double").alias("price"),
    ).cache()
    a = features.impute_ffill(shape.densify(bars, block_rows=64), ["price"], 64).cache()
    b = features.impute_ffill(shape.densify(bars), ["price"]).cache()
    cols = ["symbol", "ts", "price"]
    assert a.select(cols).exceptAll(b.select(cols)).isEmpty() and a.count() == 2 * n


def test_holidays(spark):
    days = spark.sql("select explode(sequence(date'1990-01-01', date'2040-12-31')) ts")
    got = {r[0] for r in days.where(is_federal_holiday(F.col("ts"))).collect()}
    want = {t.date() for t in USFederalHolidayCalendar().holidays("1990-01-01", "2040-12-31")}
    assert got == want


def test_weekends(bars):
    kept = {r[0] for r in features.remove_weekends(bars).select("ts").distinct().collect()}
    assert all(d.weekday() < 5 for d in kept) and dt.date(2020, 1, 3) in kept


def test_sparse_and_dropping(bars, prices):
    dense = shape.densify(bars).withColumn("rare", F.when(F.day("ts") == 3, F.col("price")))
    rare = prices[prices.index.day == 3].reindex(prices.index)
    got = features.fill_sparse(dense, ["price", "rare"], skip_warmup=False).cache()
    same(to_wide(got, "price", prices), prices)
    same(to_wide(got, "rare", prices), rare.ffill().bfill())
    whole = features.drop_incomplete(dense, ["price"]).where("panel_id = 'p'")
    assert whole.select("ts").distinct().count() == len(prices.dropna())
    empty = features.empty_features(dense.withColumn("none", F.lit(None).cast("double")), ["price", "none"])
    assert {r.feature for r in empty.collect()} == {"none"}
    with pytest.raises(ValueError):
        features.drop_incomplete(dense, ["price"], "column")


def test_interactions(bars):
    both = bars.withColumn("a", F.lit(2.0)).withColumn("b", F.lit(3.0))
    got = features.interactions(both, [("a", "b"), ("a", "zzz")])
    assert got.first()["a_x_b"] == 6.0 and "a_x_zzz" not in got.columns


def test_exogenous_modes(spark):
    """A value dated on a Saturday is lost in one mode and carried to Monday in the other."""
    days = spark.sql("select 'p' panel_id, 'A' symbol, explode(sequence(date'2021-03-01', date'2021-03-31')) ts")
    macro = spark.sql("select 'X' series_id, date'2021-03-03' ts, 1.0D value union all select 'X', date'2021-03-06', 2.0D")
    pick = lambda df: {r.ts.day: r.X for r in df.collect()}
    asof = pick(features.join_exogenous(days, macro, ["X"], "asof"))
    ref = pick(features.join_exogenous(days, macro, ["X"], "reference"))
    assert asof[1] is None and asof[5] == 1.0 and asof[8] == 2.0
    assert ref[1] == 1.0 and ref[8] == 1.0


def test_quality(bars, prices, spark):
    profile = {r.panel_id: r for r in quality.panel_profile(bars).collect()}
    assert profile["p"].n_assets == 4 and profile["p"].n_days == len(prices)
    got = quality.missing_pct(bars).where("panel_id = 'p'").toPandas().set_index("symbol")["missing_pct"]
    want = (prices.isna().mean() * 100).round(2)
    assert (got - want[want > 0]).abs().max() < 0.011
    rows = [("p", "A", f"2020-01-0{d}", v) for d, v in enumerate([1.0, -1.0, 0.0, 2.0, 3.5], 1)]
    odd = spark.createDataFrame(rows, "panel_id string, symbol string, ts string, price double")
    odd = odd.withColumn("ts", F.to_date("ts"))
    assert [r.kind for r in quality.validation_issues(odd).orderBy("kind").collect()] == [1, 2, 3]


def test_build_features(bars):
    built = features.build_features(bars, benchmark="A0", impute="interpolate").where("panel_id = 'p'")
    got = built.cache()
    assert len(got.columns) == len(set(got.columns))
    names = set(got.columns)
    assert {"return_daily_lag_21", "return_daily_rank", "sma_20_x_ema_12", "rsi_14_x_macd"} <= names
    assert all(r.ts.weekday() < 5 for r in got.select("ts").distinct().collect())
    assert got.where("return_daily is null").count() == 0 and got.count() > 0


def test_exogenous_before_a_first_row(bars):
    """A symbol that starts late has the exogenous values of its early dates, not the first later one."""
    late = bars.where("panel_id = 'p'")
    start = late.select("ts").distinct().orderBy("ts").collect()[30].ts
    last = sorted(r.symbol for r in late.select("symbol").distinct().collect())[-1]
    late = late.where((F.col("symbol") != last) | (F.col("ts") >= start))
    daily = late.select("ts").distinct().select(
        F.lit("M").alias("series_id"), "ts", F.unix_date("ts").cast("double").alias("value")
    )
    built = features.build_features(late, (daily, ["M"]), benchmark="A0", impute="interpolate")
    assert built.where((F.col("symbol") == last) & (F.col("ts") < start)).count() > 0
    assert built.where(F.col("M") != F.unix_date("ts")).count() == 0
    assert built.where("M is null").count() == 0
