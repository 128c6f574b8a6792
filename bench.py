"""Headline queries, timed: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_PANELS (default 1:
how many copies of each panel, under their own panel_id, the scaling figures use).
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from panelspark.operators import features, indicators, market
from panelspark.plans.queries import all_queries
from panelspark.schema import PANEL
from panelspark.session import local_session
from panelspark.sources.derived import Panels

HEADLINE = [
    "entry_features",
    "b03_densify",
    "b10_complete_cases",
    "c06_validation_issues",
    "d01_returns",
    "d03_sma",
    "d04_ema",
    "d06_macd",
    "d08_atr",
    "d10_volatility",
    "d11_rolling_correlation",
    "e02_cs_rank",
    "e09_impute_interpolate",
    "e12_impute_median",
    "e15_clean_features",
    "f04_avg_pairwise_correlation",
    "f06_covariance",
    "g01_volatility_regimes",
    "g13_changepoint_posterior",
    "g17_regime_characteristics",
    "h02_minimum_variance",
    "h10_adaptive_portfolio",
    "i08_compare_strategies",
]


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def scaling(panels: Panels, copies: int) -> dict[str, float]:
    """The same operators on ``copies`` panels at once."""
    ids = F.explode(F.sequence(F.lit(1), F.lit(copies)))

    def many(df):
        return df.withColumn("_k", ids).withColumn(PANEL, F.concat_ws("_", PANEL, "_k")).drop("_k")

    daily = panels.stored(f"flag_x{copies}", lambda: many(panels.flag_d))
    weekly = panels.stored(f"returns_x{copies}", lambda: many(panels.complete_returns("brand_w")))
    return {
        f"x{copies}_sma": timed(lambda: indicators.sma(daily)),
        f"x{copies}_ema": timed(lambda: indicators.ema(daily)),
        f"x{copies}_volatility": timed(lambda: indicators.volatility(daily)),
        f"x{copies}_cs_rank": timed(lambda: features.cs_rank(weekly, "ret")),
        f"x{copies}_covariance": timed(lambda: market.covariance(weekly)),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    copies = int(os.environ.get("BENCH_PANELS", "1"))
    spark = local_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    panels, runs = Panels(spark, folder), all_queries()

    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    start = time.perf_counter()
    for name in ("brand_w", "flag_d", "event_h", "macro_m", "sentiment_d"):
        getattr(panels, name)
    for name in ("brand_w", "flag_d"):
        panels.returns_of(name)
        panels.complete_returns(name)
    times["build_panels"] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        times[name] = timed(lambda: runs[name](spark, folder))
    if copies > 1:
        times.update(scaling(panels, copies))
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
