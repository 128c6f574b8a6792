"""Column names and declared schemas of the long tables every operator exchanges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

PANEL = "panel_id"
SYMBOL = "symbol"
TS = "ts"
POS = "pos"
PRICE = "price"
RET = "ret"
SERIES = [PANEL, SYMBOL]
CELL = [PANEL, SYMBOL, TS]

BARS = T.StructType(
    [
        T.StructField(PANEL, T.StringType(), False),
        T.StructField(SYMBOL, T.StringType(), False),
        T.StructField(TS, T.DateType(), False),
        T.StructField(PRICE, T.DoubleType(), True),
    ]
)
INDICATORS = T.StructType(
    [
        T.StructField("series_id", T.StringType(), False),
        T.StructField("kind", T.StringType(), False),
        T.StructField(TS, T.DateType(), False),
        T.StructField("value", T.DoubleType(), True),
    ]
)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Fail early, with the missing names, when an operator gets the wrong table."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df
