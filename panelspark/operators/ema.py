"""Exponential moving averages as a distributed linear recurrence.

With q = 1 - alpha and g panel dates since the previous value, the average is
``y = (q^g * y_prev + alpha * x) / (q^g + alpha)``, i.e. ``y_i = A_i * y_prev + B_i``. Let c be
the running sum of -ln A. Rows are cut in stretches of c-length ``STRETCH``; inside one,
``y = exp(-c) * (sum(B * exp(c)) + carry)`` is a plain running sum, and in the carry only the
last three stretches still count (each further one is damped by another 1e-6).

A series is cut in blocks by *ordinal of its observed values*. Each block reaches back far
enough for the unknown starting value to be damped below 1e-18, so no carry between blocks
is needed and no task ever holds more than one block.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.operators.blocks import BLOCK, BLOCK_ROWS, positions, spread
from panelspark.schema import PANEL, POS, SERIES, TS

STRETCH = math.log(1e6)
FORGOTTEN = 41.5  # a loss of this much leaves 1e-18 of what came before
_BLOCKED = [*SERIES, BLOCK]


def reach(span: float) -> int:
    """Observed values after which a starting value is damped below 1e-18."""
    return math.ceil(FORGOTTEN / -math.log(1 - 2 / (span + 1)))


def observed_blocks(
    df: DataFrame, halo: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Blocks by ordinal ``ord`` of the rows at hand, with halo, ``gap`` and ``next_pos``.

    Ordinals come from counts per position block plus the row number inside it.
    """
    block_rows = max(block_rows, halo + 1)
    w = Window.partitionBy(*SERIES, "_b").orderBy(POS)
    numbered = df.withColumn("_b", F.floor(F.col(POS) / block_rows)).withColumn(
        "_n", F.row_number().over(w)
    )
    counts = df.groupBy(*SERIES, F.floor(F.col(POS) / block_rows).alias("_b")).agg(
        F.count(F.lit(1)).alias("_k")
    )
    by_b = Window.partitionBy(*SERIES).orderBy("_b")
    offsets = counts.select(*SERIES, "_b", (F.sum("_k").over(by_b) - F.col("_k")).alias("_before"))
    own = F.floor(F.col("ord") / block_rows)
    place = F.col("ord") % block_rows
    copies = F.concat(
        F.array(own),
        F.when(place >= block_rows - halo, F.array(own + 1)).otherwise(F.array().cast("array<bigint>")),
        F.when((place == 0) & (own > 0), F.array(own - 1)).otherwise(F.array().cast("array<bigint>")),
    )
    blocked = (
        numbered.join(offsets, [*SERIES, "_b"])
        .withColumn("ord", F.col("_before") + F.col("_n") - 1)
        .drop("_b", "_n", "_before", "_k")
        .withColumn(BLOCK, F.explode(copies))
    )
    by_ord = Window.partitionBy(*_BLOCKED).orderBy("ord")
    return (
        blocked.withColumn("gap", F.col(POS) - F.lag(POS).over(by_ord))
        .withColumn("next_pos", F.lead(POS).over(by_ord))
        .withColumn("owned", F.floor(F.col("ord") / block_rows) == F.col(BLOCK))
        .where(F.floor(F.col("ord") / block_rows) <= F.col(BLOCK))
    )


def _scan(df: DataFrame, loss: Column, gain: Column, out: str) -> DataFrame:
    """Solve y_i = exp(-loss_i) * y_{i-1} + gain_i along ``ord`` inside each block.

    The exponents are summed again inside each stretch, so they stay small and exact. A loss is at most
    FORGOTTEN: after a longer gap nothing of the past is left, and exp() stays finite.
    """
    so_far = (Window.unboundedPreceding, Window.currentRow)
    by_ord = Window.partitionBy(*_BLOCKED).orderBy("ord")
    by_stretch = Window.partitionBy(*_BLOCKED).orderBy("_s")
    inside = Window.partitionBy(*_BLOCKED, "_s").orderBy("ord").rowsBetween(*so_far)

    def of_stretch(name: str, k: int) -> Column:
        return F.coalesce(F.sum(name).over(by_stretch.rangeBetween(-k, -k)), F.lit(0.0))

    carry = F.lit(0.0)
    for k in (3, 2, 1):
        carry = F.exp(-of_stretch("_l", k)) * (of_stretch("_u", k) + carry)
    return (
        df.withColumn("_g", gain)
        .withColumn("_l", loss)
        .withColumn("_s", F.floor(F.sum("_l").over(by_ord.rowsBetween(*so_far)) / STRETCH))
        .withColumn("_c", F.sum("_l").over(inside))
        .withColumn("_u", F.col("_g") * F.exp("_c"))
        .withColumn(out, F.exp(-F.col("_c")) * (F.sum("_u").over(inside) + carry))
        .drop("_g", "_l", "_s", "_c", "_u")
    )


def ema_step(df: DataFrame, value: str, span: float, out: str) -> DataFrame:
    """Add the gap-weighted average of ``value`` to a frame of ``observed_blocks``."""
    alpha = 2 / (span + 1)
    q = 1 - alpha
    first = F.col("gap").isNull()
    weight = F.pow(F.lit(q), F.col("gap")) + alpha
    loss = F.when(first, 0.0).otherwise(F.least(-F.col("gap") * math.log(q) + F.ln(weight), F.lit(FORGOTTEN)))
    gain = F.when(first, F.col(value)).otherwise(alpha * F.col(value) / weight)
    return _scan(df, loss, gain, out)


def held_ema_step(df: DataFrame, value: str, span: float, out: str) -> DataFrame:
    """As ``ema_step`` for an input that keeps its last value on absent dates."""
    alpha = 2 / (span + 1)
    q = 1 - alpha
    by_ord = Window.partitionBy(*_BLOCKED).orderBy("ord")
    first = F.col("gap").isNull()
    held = F.pow(F.lit(q), F.col("gap") - 1)
    loss = F.when(first, 0.0).otherwise(F.least(-F.col("gap") * math.log(q), F.lit(FORGOTTEN)))
    gain = F.when(first, F.col(value)).otherwise(
        q * (1 - held) * F.lag(value).over(by_ord) + alpha * F.col(value)
    )
    return _scan(df, loss, gain, out)


def until_next(df: DataFrame, columns: Sequence[Column], calendar: DataFrame) -> DataFrame:
    """Owned rows, repeated with their carried values up to the next observed date.

    ``columns`` may use ``held``, the number of dates since the observation.
    """
    owned = df.where("owned")
    last = F.coalesce(F.col("next_pos"), F.col("n_dates")) - 1
    rows = spread(owned, F.col(POS), last, "grid_pos").withColumn(
        "held", F.col("grid_pos") - F.col(POS)
    )
    return rows.select(*SERIES, F.col("grid_pos").alias(POS), *columns).join(
        calendar.select(PANEL, POS, TS), [PANEL, POS]
    )


def observed(bars: DataFrame, value: str) -> DataFrame:
    """Rows that carry ``value``, positioned in the calendar of all rows."""
    return positions(bars).where(F.col(value).isNotNull()).select(
        *SERIES, TS, POS, "n_dates", value
    )
