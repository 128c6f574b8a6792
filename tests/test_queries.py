"""Registered queries: a sample against SQL in another engine, and the shape of all plans."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import compare, connect  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "entry_features", "a02_read_indicators", "b03_densify", "c06_validation_issues",
    "e02_cs_rank", "g18_transition_matrix", "h04_risk_parity",
]
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 95


@needs_data
@pytest.mark.parametrize("name", SAMPLE)
def test_against_sql(spark, name):
    ok, note = compare(entry.queries()[name](spark, FOLDER), connect(FOLDER), entry.oracle_sql()[name])
    assert ok, note


@needs_data
@pytest.mark.parametrize("name", ["d01_returns", "d10_volatility", "d11_rolling_correlation", "e03_cs_zscore", "f03_market_volatility"])
def test_no_single_task_plans(spark, name):
    """No product of tables and no window over an unpartitioned table."""
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "SinglePartition" not in plan


@needs_data
def test_windows_share_one_exchange(spark):
    """Returns, averages and volatility of one frame sort and shuffle the blocks once."""
    from panelspark.operators import indicators
    from panelspark.sources.derived import Panels

    df = indicators.sma(Panels(spark, FOLDER).flag_d)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(panel_id#\d+, symbol#\d+, block", plan)) == 1
    assert "ReadSchema" in plan and "volume" not in plan.split("ReadSchema")[-1]
