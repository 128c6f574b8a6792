"""Scalar and aggregate helpers shared by the operators. NULL is the only missing value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRADING_DAYS = 252  # fixed value: annualisation factor


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL when b is zero (ANSI division would raise)."""
    return F.try_divide(a, b)


def finite(c: Column) -> Column:
    """NaN and infinities become NULL."""
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), None).otherwise(c)


def log_positive(c: Column) -> Column:
    return F.when(c > 0, F.ln(c))


def sample_skew(c: Column) -> Column:
    """Bias-corrected skewness; NULL below three values, 0 when all values are equal."""
    n = F.count(c).cast("double")
    g1 = F.skewness(c)
    flat = F.when(F.max(c) == F.min(c), F.lit(0.0))
    return F.when(n >= 3, F.coalesce(flat, g1 * F.sqrt(n * (n - 1)) / (n - 2)))


def sample_kurtosis(c: Column) -> Column:
    """Bias-corrected excess kurtosis; NULL below four values, 0 when all values are equal."""
    n = F.count(c).cast("double")
    g2 = F.kurtosis(c)
    flat = F.when(F.max(c) == F.min(c), F.lit(0.0))
    return F.when(
        n >= 4, F.coalesce(flat, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    )


def rounded(df: DataFrame, digits: int = 6, **overrides: int) -> DataFrame:
    """Round every double column for comparison at the edge; other types pass through.

    Prices are cents over small quantities, so exact decimal ties are common. A nudge well
    below the last digit makes a tie round the same way whatever its last bit is.
    """
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            n = overrides.get(field.name, digits)
            c = F.round(c + 0.03 * 10**-n, n).alias(field.name)
        out.append(c)
    return df.select(*out)
