"""Changes of mean and variance in one series per panel, by exact conjugate posteriors.

A segment's marginal likelihood under a Normal-Inverse-Gamma prior needs its length, sum and
sum of squares only. Those are differences of prefix sums, so every possible change of every
open segment of every panel is weighed in one narrow pass per round.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.numeric import ratio
from panelspark.operators.blocks import figures, positions, running, with_figures
from panelspark.operators.regimes import segments_to_regimes
from panelspark.schema import PANEL, POS, TS
from panelspark.session import release, stage

KAPPA0, A0, B0 = 1.0, 1.0, 1.0  # prior of a standardised series
EDGE = 0.1  # changes are kept inside [10 %, 90 %) of the series


def _ln_gamma(x: str) -> str:
    """Stirling's series after moving the argument up by eight; accurate for x > 0."""
    product = " * ".join(f"({x} + {k})" for k in range(8))
    y = f"({x} + 8)"
    series = f"1 / (12 * {y}) - 1 / (360 * pow({y}, 3)) + 1 / (1260 * pow({y}, 5)) - 1 / (1680 * pow({y}, 7))"
    return f"(({y} - 0.5) * ln({y}) - {y} + {0.5 * math.log(2 * math.pi)} + {series} - ln({product}))"


def ln_gamma(x: str) -> Column:
    """Logarithm of the gamma function of a double column."""
    return F.expr(_ln_gamma(x))


def log_marginal(n: str, s1: str, s2: str) -> Column:
    """Log marginal likelihood of a segment with its length, sum and sum of squares."""
    n = f"cast({n} as double)"
    a = f"({A0} + {n} / 2)"
    b = f"({B0} + 0.5 * greatest({s2} - ({s1}) * ({s1}) / ({KAPPA0} + {n}), 0.0D))"
    const = A0 * math.log(B0) - math.lgamma(A0)
    return F.expr(
        f"-{n} / 2 * {math.log(2 * math.pi)} + 0.5 * ln({KAPPA0} / ({KAPPA0} + {n})) + {const}"
        f" - {a} * ln({b}) + {_ln_gamma(a)}"
    )


def prefixed(series: DataFrame, value: str) -> DataFrame:
    """Standardised values ``z`` with the sums before each position, ``c1`` and ``c2``."""
    placed = positions(series.select(PANEL, TS, value).where(F.col(value).isNotNull()))
    stats = figures(placed, [PANEL], F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    z = F.coalesce(ratio(F.col(value) - F.col("_m"), F.col("_s")), F.lit(0.0))
    rows = with_figures(placed, stats, [PANEL]).select(PANEL, TS, POS, "n_dates", z.alias("z"))
    summed = running(
        rows, [PANEL], {"c1": ("sum", F.col("z")), "c2": ("sum", F.col("z") * F.col("z"))}
    )
    return summed.withColumn("c1", F.col("c1") - F.col("z")).withColumn(
        "c2", F.col("c2") - F.col("z") * F.col("z")
    )


def _within_edges() -> Column:
    return (F.col(POS) >= F.floor(F.col("n_dates") * EDGE)) & (
        F.col(POS) < F.floor(F.col("n_dates") * (1 - EDGE))
    )


def changepoint_posterior(series: DataFrame, value: str) -> DataFrame:
    """Posterior of where a single change happened, and the log Bayes factor for one at all.

    A change at a date means that the date opens the second segment.
    """
    rows = stage(prefixed(series, value))
    total = figures(
        rows,
        [PANEL],
        F.count(F.lit(1)).alias("n"),
        F.sum("z").alias("t1"),
        F.sum(F.col("z") * F.col("z")).alias("t2"),
    )
    weight = log_marginal("pos", "c1", "c2") + log_marginal("(n - pos)", "t1 - c1", "t2 - c2")
    inner = rows.where(_within_edges() & (F.col(POS) > 0))
    weighed = with_figures(inner, total, [PANEL]).select(
        PANEL, TS, POS, weight.alias("lw"), log_marginal("n", "t1", "t2").alias("one")
    )
    top = figures(weighed, [PANEL], F.max("lw").alias("top"))
    scaled = with_figures(weighed, top, [PANEL])
    norm = figures(
        scaled,
        [PANEL],
        F.sum(F.exp(F.col("lw") - F.col("top"))).alias("norm"),
        F.count(F.lit(1)).alias("places"),
    )
    evidence = F.col("top") + F.ln("norm") - F.ln("places") - F.col("one")
    return with_figures(scaled, norm, [PANEL]).select(
        PANEL,
        TS,
        POS,
        (F.exp(F.col("lw") - F.col("top")) / F.col("norm")).alias("probability"),
        evidence.alias("log_bayes_factor"),
    )


def _split_gain() -> Column:
    """Evidence for opening a new segment at ``pos`` against leaving the segment whole."""
    return (
        log_marginal("(pos - seg)", "c1 - b1", "c2 - b2")
        + log_marginal("(n - pos + seg)", "t1 - c1 + b1", "t2 - c2 + b2")
        - log_marginal("n", "t1", "t2")
    )


def _best_splits(rows: DataFrame, starts: DataFrame, gain: Column, threshold: float) -> DataFrame:
    """For each open segment its most likely change, if the evidence exceeds the threshold."""
    marked = rows.join(starts, [PANEL, POS], "left")
    named = running(marked, [PANEL], {"seg": ("max", F.when(F.col("open").isNotNull(), F.col(POS)))}).drop("open")
    opened = starts.where("open").select(PANEL, F.col(POS).alias("seg"))
    inside = stage(named.join(opened, [PANEL, "seg"]))
    totals = inside.groupBy(PANEL, "seg").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by("c1", POS).alias("b1"),
        F.min_by("c2", POS).alias("b2"),
        F.sum("z").alias("t1"),
        F.sum(F.col("z") * F.col("z")).alias("t2"),
    )
    joined = inside.join(totals, [PANEL, "seg"])
    k = F.col(POS) - F.col("seg")
    weighed = joined.where(
        (k >= F.col("spacing")) & (F.col("n") - k >= F.col("spacing"))
    ).select(PANEL, "seg", POS, gain.alias("lw"))
    weighed = stage(weighed)
    top = weighed.groupBy(PANEL, "seg").agg(F.max("lw").alias("top"), F.max_by(POS, "lw").alias("at"))
    return (
        weighed.join(top, [PANEL, "seg"])
        .groupBy(PANEL, "seg", "at")
        .agg(
            (F.max("top") + F.ln(F.sum(F.exp(F.col("lw") - F.col("top")))) - F.ln(F.count(F.lit(1)))).alias("bf")
        )
        .where(F.col("bf") > threshold)
    )


def changepoints(
    series: DataFrame,
    value: str,
    n_regimes: int = 4,
    max_changes: int | None = None,
    min_spacing: int | None = None,
    threshold: float = 3.0,
) -> DataFrame:
    """Every date with ``is_change``: recursive splitting until no segment wants a change.

    One job per round works on all open segments of all panels. A panel gets at most
    ``max_changes``, by default max(15, 6 * n_regimes) for every 1,000 dates; a round that would
    exceed it takes its best supported ones. Segments are at least
    ``min_spacing`` dates long, by default max(5, length / 200).
    """
    limit = (
        F.lit(max(15, 6 * n_regimes)) * F.ceil(F.col("n_dates") / 1000)
        if max_changes is None
        else F.lit(max_changes)
    )
    spacing = (
        F.greatest(F.lit(5).cast("bigint"), F.floor(F.col("n_dates") / 200))
        if min_spacing is None
        else F.lit(min_spacing).cast("bigint")
    )
    rows = stage(prefixed(series, value).withColumn("spacing", spacing))
    starts = stage(rows.where(F.col(POS) == 0).select(PANEL, POS, F.lit(True).alias("open")))
    gain = _split_gain()
    limits = rows.where(F.col(POS) == 0).select(PANEL, limit.alias("limit"))
    while True:
        used = starts.groupBy(PANEL).agg((F.count(F.lit(1)) - 1).alias("used")).join(limits, PANEL)
        order = Window.partitionBy(PANEL).orderBy(F.desc("bf"), "seg")
        splits = stage(
            _best_splits(rows, starts, gain, threshold)
            .join(used, PANEL)
            .withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") + F.col("used") <= F.col("limit"))
            .select(PANEL, "seg", "at")
        )
        if splits.isEmpty():
            break
        again = splits.select(PANEL, F.col("seg").alias(POS), F.lit(True).alias("_split"))
        kept = starts.join(again, [PANEL, POS], "left").select(
            PANEL, POS, F.col("_split").isNotNull().alias("open")
        )
        added = splits.select(PANEL, F.col("at").alias(POS), F.lit(True).alias("open"))
        last, starts = starts, stage(kept.unionByName(added))
        release(last)
        release(splits)
    found = starts.where(F.col(POS) > 0).select(PANEL, POS, F.lit(True).alias("found"))
    return rows.join(found, [PANEL, POS], "left").select(
        PANEL, TS, POS, "n_dates", (F.col("found").isNotNull() & _within_edges()).alias("is_change")
    )


def changepoint_regimes(series: DataFrame, value: str, n_regimes: int = 4, **options: float) -> DataFrame:
    """Segments between changes as regimes, round-robin."""
    return segments_to_regimes(changepoints(series, value, n_regimes, **options), n_regimes)
