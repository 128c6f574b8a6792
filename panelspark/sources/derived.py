"""Panels derived from the order, line-item, part and event tables.

Each is written once per application to the shared folder and read back, so that the raw
tables are scanned once and later plans prune columns on the small stored panel.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators.backtest import backtest, constant_weights
from panelspark.operators.blocks import positions
from panelspark.operators.indicators import returns
from panelspark.operators.market import covariance, regime_features
from panelspark.operators.regimes import volatility_regimes
from panelspark.operators.shape import complete_cases
from panelspark.schema import CELL, PANEL, PRICE, RET, SYMBOL, TS
from panelspark.session import shared_dir, ship_package

_STORED: dict[tuple[str, str, str], str] = {}


def _week(c: str) -> Column:
    return F.date_trunc("week", F.col(c)).cast("date")


class Panels:
    """The derived panels of one table folder, stored with their calendar positions."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        ship_package(spark)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def stored(self, name: str, build) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _STORED:
            tag = hashlib.sha256("|".join(key).encode()).hexdigest()[:16]
            path = f"{shared_dir(self.spark)}/panels/{tag}/{name}"
            df = build()
            df = positions(df) if SYMBOL in df.columns and TS in df.columns else df
            df.write.mode("overwrite").parquet(path)
            _STORED[key] = path
        return self.spark.read.parquet(_STORED[key])

    @property
    def brand_w(self) -> DataFrame:
        """Weekly unit price per brand: the cross-section, portfolio and backtest panel."""

        def build() -> DataFrame:
            lines = self.table("lineitem").select(
                "l_partkey", "l_shipdate", "l_extendedprice", "l_quantity"
            )
            parts = self.table("part").select("p_partkey", "p_brand")
            return (
                lines.join(parts, lines.l_partkey == parts.p_partkey)
                .groupBy(F.col("p_brand").alias(SYMBOL), _week("l_shipdate").alias(TS))
                .agg((F.sum("l_extendedprice") / F.sum("l_quantity")).alias(PRICE))
                .select(F.lit("brand_w").alias(PANEL), SYMBOL, TS, PRICE)
            )

        return self.stored("brand_w", build)

    @property
    def flag_d(self) -> DataFrame:
        """Daily high, low, close and volume per return flag and line status."""

        def build() -> DataFrame:
            unit = F.col("l_extendedprice") / F.col("l_quantity")
            return (
                self.table("lineitem")
                .groupBy(
                    F.concat_ws("_", "l_returnflag", "l_linestatus").alias(SYMBOL),
                    F.col("l_shipdate").cast("date").alias(TS),
                )
                .agg(
                    F.max(unit).alias("high"),
                    F.min(unit).alias("low"),
                    (F.sum("l_extendedprice") / F.sum("l_quantity")).alias(PRICE),
                    F.sum("l_quantity").alias("volume"),
                )
                .select(F.lit("flag_d").alias(PANEL), SYMBOL, TS, "high", "low", PRICE, "volume")
            )

        return self.stored("flag_d", build)

    @property
    def event_h(self) -> DataFrame:
        """Hourly high, low and mean of the event values per event type."""

        def build() -> DataFrame:
            return (
                self.table("events")
                .groupBy(
                    F.col("event_type").alias(SYMBOL),
                    F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias(TS),
                )
                .agg(
                    F.max("value").alias("high"),
                    F.min("value").alias("low"),
                    F.avg("value").alias(PRICE),
                )
                .select(F.lit("event_h").alias(PANEL), SYMBOL, TS, "high", "low", PRICE)
            )

        return self.stored("event_h", build)

    def _order_series(self, name: str, series: str, day: Column, kind: str) -> DataFrame:
        def build() -> DataFrame:
            return (
                self.table("orders")
                .groupBy(F.col(series).alias("series_id"), day.alias(TS))
                .agg(F.avg("o_totalprice").alias("value"))
                .select("series_id", F.lit(kind).alias("kind"), TS, "value")
            )

        return self.stored(name, build)

    @property
    def macro_m(self) -> DataFrame:
        """Monthly mean order price per priority: sparse, first of month."""
        day = F.date_trunc("month", F.col("o_orderdate")).cast("date")
        return self._order_series("macro_m", "o_orderpriority", day, "macro")

    @property
    def sentiment_d(self) -> DataFrame:
        """Daily mean order price per order status."""
        return self._order_series(
            "sentiment_d", "o_orderstatus", F.col("o_orderdate").cast("date"), "sentiment"
        )

    def returns_of(self, name: str) -> DataFrame:
        """Padded daily returns of a panel as ``ret``, stored."""

        def build() -> DataFrame:
            return returns(getattr(self, name), [1]).select(
                *CELL, F.col("return_daily").alias(RET), "pos", "n_dates"
            )

        return self.stored(f"returns_{name}", build)

    def complete_returns(self, name: str) -> DataFrame:
        """The dates of ``returns_of`` on which every symbol has a return, stored."""
        return self.stored(f"complete_{name}", lambda: complete_cases(self.returns_of(name)))

    @property
    def regime_features(self) -> DataFrame:
        return self.stored(
            "regime_features", lambda: regime_features(self.complete_returns("brand_w"))
        )

    @property
    def volatility_regimes(self) -> DataFrame:
        return self.stored(
            "volatility_regimes", lambda: volatility_regimes(self.complete_returns("brand_w"))
        )

    @property
    def brand_covariance(self) -> DataFrame:
        return self.stored("brand_covariance", lambda: covariance(self.complete_returns("brand_w")))

    def ledger(self, strategies) -> DataFrame:
        """Backtest of constant strategies over the weekly brand returns."""

        def build() -> DataFrame:
            returns = self.complete_returns("brand_w")
            return backtest(constant_weights(strategies(self), returns), returns)

        return self.stored("ledger", build)
