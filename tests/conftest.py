import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelspark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def to_long(wide: pd.DataFrame, value: str, panel: str = "p") -> pd.DataFrame:
    """Long rows of a date x symbol frame; absent values give no row."""
    long = wide.rename_axis(index="ts", columns="symbol").stack().dropna().rename(value).reset_index()
    long["ts"] = pd.to_datetime(long["ts"]).dt.date
    long.insert(0, "panel_id", panel)
    return long[["panel_id", "symbol", "ts", value]]


def to_frame(spark, wide: pd.DataFrame, value: str):
    """The same frame as two panels; the second is a shorter copy, so panels must not mix."""
    both = pd.concat([to_long(wide, value), to_long(wide.iloc[: len(wide) // 2], value, "q")])
    schema = f"panel_id string, symbol string, ts date, {value} double"
    return spark.createDataFrame(both, schema).cache()


def to_wide(df, value: str, like: pd.DataFrame, panel: str = "p") -> pd.DataFrame:
    got = df.where(f"panel_id = '{panel}'").select("symbol", "ts", value).toPandas()
    assert not got.duplicated(["symbol", "ts"]).any()
    got = got.pivot(index="ts", columns="symbol", values=value)
    got.index = pd.to_datetime(got.index)
    return got.reindex(index=like.index, columns=like.columns).astype(float)


def same(got: pd.DataFrame, want: pd.DataFrame, tol: float = 1e-9) -> None:
    np.testing.assert_allclose(got.to_numpy(float), want.to_numpy(float), rtol=tol, atol=tol, equal_nan=True)


@pytest.fixture(scope="session")
def prices() -> pd.DataFrame:
    """Random walk with scattered gaps, a long hole, a late start and an early end."""
    rng = np.random.default_rng(42)
    dates = pd.date_range("2020-01-01", periods=160)
    p = pd.DataFrame(
        {f"A{i}": 100 * np.exp(np.cumsum(rng.normal(0, 0.01, 160))) for i in range(4)}, index=dates
    )
    p = p.mask(rng.random(p.shape) < 0.12)
    p.iloc[60:100, 1] = np.nan
    p.iloc[:25, 2] = np.nan
    p.iloc[-30:, 3] = np.nan
    return p


@pytest.fixture(scope="session")
def bars(spark, prices):
    return to_frame(spark, prices, "price")


@pytest.fixture(scope="session")
def complete(spark):
    """Returns without gaps: four regimes of volatility."""
    rng = np.random.default_rng(42)
    sd = np.repeat([0.005, 0.025, 0.008, 0.030], [75, 75, 75, 25])[:, None]
    r = pd.DataFrame(
        rng.normal(0, 1, (250, 5)) * sd + rng.normal(0, 1, (250, 1)) * sd,
        index=pd.date_range("2020-01-01", periods=250),
        columns=[f"A{i}" for i in range(5)],
    )
    return r, to_frame(spark, r, "ret")
