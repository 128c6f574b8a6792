"""Data quality of a price panel: one profile row per panel and one row per finding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.blocks import BLOCK, block_window, core, padded_grid, shift
from panelspark.operators.shape import top_k
from panelspark.schema import PANEL, POS, PRICE, SERIES, SYMBOL, TS

EXTREME_RETURN = 0.5  # fixed value: absolute daily return


def panel_profile(bars: DataFrame) -> DataFrame:
    """Number of assets and dates, first and last date."""
    symbols = bars.groupBy(*SERIES).agg(F.lit(1).alias("one")).groupBy(PANEL).agg(
        F.count(F.lit(1)).alias("n_assets")
    )
    dates = bars.groupBy(PANEL, TS).agg(F.lit(1).alias("one")).groupBy(PANEL).agg(
        F.count(F.lit(1)).alias("n_days"),
        F.min(TS).alias("first_date"),
        F.max(TS).alias("last_date"),
    )
    return symbols.join(dates, PANEL)


def missing_pct(bars: DataFrame) -> DataFrame:
    """Share of panel dates without a price, in per cent; complete symbols are left out.

    Counts the rows a symbol has instead of building the ones it lacks.
    """
    days = bars.groupBy(PANEL, TS).agg(F.lit(1).alias("one")).groupBy(PANEL).agg(
        F.count(F.lit(1)).alias("n_days")
    )
    have = bars.groupBy(*SERIES).agg(F.count(PRICE).alias("n"))
    share = (F.col("n_days") - F.col("n")) / F.col("n_days") * 100
    return (
        have.join(days, PANEL)
        .select(*SERIES, F.round(share, 2).alias("missing_pct"))
        .where("missing_pct > 0")
    )


def price_sign_checks(bars: DataFrame) -> DataFrame:
    """Per symbol, whether any price is negative or zero."""
    return bars.groupBy(*SERIES).agg(
        F.coalesce(F.max(F.col(PRICE) < 0), F.lit(False)).alias("has_negative"),
        F.coalesce(F.max(F.col(PRICE) == 0), F.lit(False)).alias("has_zero"),
    )


def negative_price_check(bars: DataFrame) -> DataFrame:
    return price_sign_checks(bars).select(*SERIES, "has_negative")


def zero_price_check(bars: DataFrame) -> DataFrame:
    return price_sign_checks(bars).select(*SERIES, "has_zero")


def extreme_return_check(bars: DataFrame, threshold: float = EXTREME_RETURN) -> DataFrame:
    """Number of daily returns beyond the threshold, per symbol; a jump away from zero is one."""
    rows = padded_grid(bars, 1)
    price = F.col(f"{PRICE}_pad")
    before = shift(price, 1, block_window())
    beyond = F.when(before == 0, price != 0).otherwise(F.abs(price / F.nullif(before, F.lit(0.0)) - 1) > threshold)
    daily = core(rows.select(*SERIES, POS, BLOCK, beyond.alias("beyond")), 1)
    return daily.groupBy(*SERIES).agg(F.count_if("beyond").alias("n_extreme"))


def validation_issues(bars: DataFrame, show: int | None = None) -> DataFrame:
    """All findings; for a report, ``show`` keeps the first of each panel, by symbol and kind."""
    signs = price_sign_checks(bars)
    found = [
        signs.where("has_negative").select(
            *SERIES, F.lit(1).alias("kind"), F.lit("Contains negative prices").alias("issue")
        ),
        signs.where("has_zero").select(
            *SERIES, F.lit(2).alias("kind"), F.lit("Contains zero prices").alias("issue")
        ),
        extreme_return_check(bars)
        .where("n_extreme > 0")
        .select(
            *SERIES,
            F.lit(3).alias("kind"),
            F.concat(F.col("n_extreme"), F.lit(" extreme daily returns (>50%)")).alias("issue"),
        ),
    ]
    issues = found[0].unionByName(found[1]).unionByName(found[2])
    if show is None:
        return issues
    return top_k(issues, show, [F.col(SYMBOL), F.col("kind")], [PANEL])
