"""The default universe and indicator descriptions as small tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.schema import SYMBOL

# fixed values: default asset universe
ASSET_UNIVERSE = {
    "equity": [
        "SPY", "QQQ", "IWM", "VTI", "EFA", "EEM", "XLK", "XLF", "XLE", "XLV", "XLI", "XLC", "XLY", "XLP",
        "XLU", "XLRE", "XLB",
    ],
    "fixed_income": ["TLT", "IEF", "SHY", "LQD", "HYG", "TIP", "MUB", "EMB"],
    "commodity": ["GLD", "SLV", "USO", "DBA", "DBB", "UNG"],
    "currency": ["UUP", "FXE", "FXY", "FXB", "FXA"],
    "alternative": ["VNQ", "VIXY"],
}

# fixed values: macroeconomic and sentiment series
MACRO_INDICATORS = {
    "DGS10": "10-Year Treasury Rate",
    "DGS2": "2-Year Treasury Rate",
    "DFF": "Federal Funds Rate",
    "T10Y2Y": "10Y-2Y Treasury Spread",
    "T10Y3M": "10Y-3M Treasury Spread",
    "CPIAUCSL": "CPI (All Urban Consumers)",
    "PCEPI": "PCE Price Index",
    "CPILFESL": "Core CPI",
    "UNRATE": "Unemployment Rate",
    "PAYEMS": "Nonfarm Payrolls",
    "ICSA": "Initial Jobless Claims",
    "GDP": "Gross Domestic Product",
    "GDPC1": "Real GDP",
    "INDPRO": "Industrial Production Index",
    "UMCSENT": "U. of Michigan Consumer Sentiment",
    "RSXFS": "Retail Sales",
    "HOUST": "Housing Starts",
    "M2SL": "M2 Money Supply",
    "TOTALSL": "Total Consumer Credit",
    "DCOILWTICO": "WTI Crude Oil Price",
}
SENTIMENT_INDICATORS = {
    "^VIX": "CBOE Volatility Index",
    "^SKEW": "CBOE Skew Index",
    "^VXN": "Nasdaq Volatility",
}


def dim_asset(spark: SparkSession) -> DataFrame:
    rows = [(s, kind) for kind, names in ASSET_UNIVERSE.items() for s in names]
    return spark.createDataFrame(rows, f"{SYMBOL} string, asset_class string")


def dim_indicator(spark: SparkSession) -> DataFrame:
    rows = [(i, n, "macro") for i, n in MACRO_INDICATORS.items()]
    rows += [(i, n, "sentiment") for i, n in SENTIMENT_INDICATORS.items()]
    return spark.createDataFrame(rows, "series_id string, name string, kind string")


def describe(df: DataFrame, dim: DataFrame, key: str = SYMBOL) -> DataFrame:
    """Rows with their dimension; keys the dimension does not know stay, undescribed.

    Spark broadcasts the dimension when its size is below the session's threshold.
    """
    return df.join(dim, key, "left")


def class_counts(bars: DataFrame, dim: DataFrame) -> DataFrame:
    """Symbols and rows per asset class; counts per symbol are joined, not rows."""
    per_symbol = bars.groupBy(SYMBOL).agg(F.count(F.lit(1)).alias("n"))
    return (
        describe(per_symbol, dim)
        .groupBy("asset_class")
        .agg(F.count(F.lit(1)).alias("n_symbols"), F.sum("n").alias("n_rows"))
    )
