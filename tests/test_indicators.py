"""Every indicator against pandas, in one block and in many small ones."""

import numpy as np
import pytest
from conftest import same, to_wide
from pyspark.sql import functions as F

from panelspark.operators import indicators as ind

BLOCKS = [16_384, 40]


@pytest.mark.parametrize("rows", BLOCKS)
def test_returns_and_windows(bars, prices, rows):
    half = prices.iloc[:80]
    daily = prices.ffill().pct_change(fill_method=None)
    got = ind.returns(bars, [1, 5], block_rows=rows).cache()
    same(to_wide(got, "return_daily", prices), daily)
    same(to_wide(got, "return_5d", prices), prices.ffill().pct_change(5, fill_method=None))
    same(to_wide(got, "return_daily", half, "q"), half.ffill().pct_change(fill_method=None))
    plain = ind.returns(bars, [1], pad=False, block_rows=rows)
    same(to_wide(plain, "return_daily", prices), prices / prices.shift() - 1)
    same(to_wide(ind.log_return(bars, rows), "log_return", prices), np.log(prices / prices.shift()))
    same(to_wide(ind.sma(bars, [3, 20], rows), "sma_3", prices), prices.rolling(3).mean())
    same(to_wide(ind.momentum(bars, [10], rows), "momentum_10", prices), prices / prices.shift(10) - 1)
    vol = daily.rolling(20).std() * np.sqrt(252)
    same(to_wide(ind.volatility(bars, [20], rows), "vol_20", prices), vol)


@pytest.mark.parametrize("rows", BLOCKS)
def test_exponential_averages(bars, prices, rows):
    got = ind.ema(bars, [3, 26], rows).cache()
    for span in (3, 26):
        same(to_wide(got, f"ema_{span}", prices), prices.ewm(span=span, adjust=False).mean())
    line = prices.ewm(span=3, adjust=False).mean() - prices.ewm(span=8, adjust=False).mean()
    signal = line.ewm(span=4, adjust=False).mean()
    got = ind.macd(bars, 3, 8, 4, rows).cache()
    same(to_wide(got, "macd", prices), line)
    same(to_wide(got, "macd_signal", prices), signal)
    same(to_wide(got, "macd_hist", prices), line - signal)


def test_ema_long_series(spark):
    """Longer than many blocks: the halo has to make up for the missing carry."""
    x = spark.range(3_000).select(
        F.lit("p").alias("panel_id"), F.lit("A").alias("symbol"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("ts"),
        (100 + 10 * F.sin(F.col("id") / 50) + F.rand(1)).alias("price"),
    ).cache()
    want = x.orderBy("ts").toPandas()["price"].ewm(span=12, adjust=False).mean().to_numpy()
    got = ind.ema(x, [12], 300).orderBy("ts").toPandas()["ema_12"].to_numpy()
    np.testing.assert_allclose(got, want, rtol=1e-13)


def test_rsi_bollinger(bars, prices):
    delta = prices.diff()
    gain, loss = delta.where(~(delta < 0), 0), delta.where(~(delta > 0), 0).abs()
    rs = gain.rolling(4).mean() / loss.rolling(4).mean()
    got = ind.rsi(bars, 4, 40)
    same(to_wide(got, "rsi_4", prices), 100 - 100 / (1 + rs))
    assert got.where("rsi_4 < 0 or rsi_4 > 100").count() == 0
    mid, sd = prices.rolling(5).mean(), prices.rolling(5).std()
    got = ind.bollinger(bars, 5, 2.0, 40).cache()
    same(to_wide(got, "bb_upper", prices), mid + 2 * sd)
    same(to_wide(got, "bb_width", prices), 4 * sd / mid)
    same(to_wide(got, "bb_pct", prices), (prices - mid + 2 * sd) / (4 * sd))


def test_constant_prices_give_null(spark):
    rows = [("p", "A", f"2020-01-{d:02d}", 5.0) for d in range(1, 31)]
    flat = spark.createDataFrame(rows, "panel_id string, symbol string, ts string, price double")
    flat = flat.withColumn("ts", F.to_date("ts"))
    assert ind.rsi(flat).where("rsi_14 is not null").count() == 0
    assert ind.bollinger(flat).where("bb_pct is not null").count() == 0


def test_correlation(bars, prices):
    r = prices.ffill().pct_change(fill_method=None)
    got = ind.rolling_correlation(bars, "A0", 30, 40).cache()
    assert got.where("symbol = 'A0'").count() == 0
    want = r[["A2"]].rolling(30).corr(r["A0"])
    same(to_wide(got, "corr_A0_30", want), want)
    assert ind.rolling_correlation(bars, "SPY", 30).count() == 0


def test_atr_and_composite(bars, prices):
    ohlc = bars.withColumn("high", F.col("price") * 1.01).withColumn("low", F.col("price") * 0.98)
    high, low, before = prices * 1.01, prices * 0.98, prices.shift()
    parts = [(high - low), (high - before).abs(), (low - before).abs()]
    tr = parts[0].where((parts[0] >= parts[1]) | False, parts[1])
    tr = tr.where(tr >= parts[2], parts[2])
    want = tr.ewm(span=14, adjust=False).mean()
    same(to_wide(ind.atr(ohlc, 14, 40), "atr_14", prices), want)
    every = ind.all_indicators(ohlc, "A0").cache()
    assert len(every.columns) == len(set(every.columns))
    same(to_wide(every, "atr_14", prices), want)
    same(to_wide(every, "ema_12", prices), prices.ewm(span=12, adjust=False).mean())
    same(to_wide(every, "sma_20", prices), prices.rolling(20).mean())
