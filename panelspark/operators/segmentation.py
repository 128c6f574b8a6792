"""The best segmentation with a fixed number of changes, exactly, by dynamic programming over blocks.

The evidence of a segmentation is the sum of its segments' log marginal likelihoods. The best one whose last
segment opens at a date depends on the best ones before it, so a round adds one change: every pair of
(block of openings, later block of next openings) is one max-plus product in a task, and dates keep the
maximum over the pairs that end at them. All pairs of all panels are one job a round.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.blocks import with_figures
from panelspark.operators.changepoint import A0, B0, EDGE, KAPPA0, prefixed
from panelspark.schema import PANEL, POS, TS
from panelspark.session import release, stage

#: Positions of a block; a task holds a few matrices of this size.
SIDE = 512
_STATE = f"{PANEL} string, {POS} long, value double, opened long"


def _ln_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after moving the argument up by eight."""
    y = x + 8.0
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    product = np.sum([np.log(x + k) for k in range(8)], axis=0)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - product


def _marginals(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Log marginal likelihood of each segment [start, stop); rows of both are (pos, c1, c2). -inf where empty."""
    n = stop[None, :, 0] - start[:, None, 0]
    ok = n > 0
    n = np.where(ok, n, 1.0)
    s1, s2 = (stop[None, :, k] - start[:, None, k] for k in (1, 2))
    b = B0 + 0.5 * np.maximum(s2 - s1 * s1 / (KAPPA0 + n), 0.0)
    # lengths of a pair of blocks are few, so the gamma function is taken once for each
    sizes = np.arange(n.min(), n.max() + 1)
    const = A0 * math.log(B0) - math.lgamma(A0)
    own = -sizes / 2 * math.log(2 * math.pi) + 0.5 * np.log(KAPPA0 / (KAPPA0 + sizes)) + const + _ln_gamma(A0 + sizes / 2)
    return np.where(ok, own[(n - sizes[0]).astype(np.int64)] - (A0 + n / 2) * np.log(b), -np.inf)


def _packed(rows: DataFrame, columns: list[str], name: str) -> DataFrame:
    """A row per panel and block: the columns of its positions in order, as one array."""
    cell = F.struct(*[F.col(c).cast("double").alias(c) for c in columns])
    out = rows.groupBy(PANEL, F.floor(F.col(POS) / SIDE).alias("block")).agg(F.array_sort(F.collect_list(cell)).alias("_cells"))
    flat = F.flatten(F.transform("_cells", lambda c: F.array(*[c[k] for k in columns])))
    return out.select(PANEL, F.col("block").alias(f"{name}_block"), flat.alias(name))


def _extend(state: DataFrame, ends: DataFrame, spacing: DataFrame) -> DataFrame:
    """For every end its best opening: value of the state there plus the segment from it to the end.

    ``state``: panel, pos, c1, c2, value. ``ends``: panel, pos, c1, c2. ``spacing``: panel, spacing, last_block. A block of
    openings is sent to every later block; pairs are dealt out by (panel, both blocks).
    """
    left = _packed(state, [POS, "c1", "c2", "value"], "a").join(spacing, PANEL)
    left = left.withColumn("b_block", F.explode(F.sequence("a_block", "last_block")))
    right = _packed(ends, [POS, "c1", "c2"], "b")
    pairs = left.join(right, [PANEL, "b_block"]).repartition(PANEL, "a_block", "b_block")

    def run(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                a, b = np.asarray(row.a).reshape(-1, 4), np.asarray(row.b).reshape(-1, 3)
                found = a[:, 3][:, None] + _marginals(a[:, :3], b)
                found[b[None, :, 0] - a[:, 0][:, None] < row.spacing] = -np.inf
                best = found.argmax(axis=0)  # the first of equals
                value = found[best, np.arange(len(b))]
                ok = np.isfinite(value)
                if ok.any():
                    yield pd.DataFrame(
                        {PANEL: row.panel_id, POS: b[ok, 0].astype("int64"), "value": value[ok], "opened": a[best[ok], 0].astype("int64")}
                    )

    found = pairs.select(PANEL, "a", "b", "spacing").mapInPandas(run, _STATE)
    # the largest value, of equal ones the earliest opening
    best = F.max_by(F.struct("value", "opened"), F.struct("value", -F.col("opened")))
    return found.groupBy(PANEL, POS).agg(best.alias("best")).select(PANEL, POS, "best.value", "best.opened")


def fixed_changepoints(
    series: DataFrame, value: str, n_regimes: int = 4, min_spacing: int | None = None
) -> DataFrame:
    """Every date with ``is_change`` and the panel's ``log_evidence``: exactly n_regimes - 1 changes.

    Changes lie in [10 %, 90 %) of the series and at least ``min_spacing`` dates apart, by default
    max(5, length / 50); of all such choices the one with the largest evidence is taken, of equal ones
    the earlier openings. A series too short for them has none and NULL evidence. NULL values are left out; an
    empty table gives an empty result. One round per change, two more for the end and the way back; a panel
    of n dates costs n * n / 2 cells a round, in tasks of SIDE * SIDE.
    """
    if n_regimes < 1:
        raise ValueError("n_regimes has to be 1 or more")
    rows = stage(prefixed(series, value))
    gap = (
        F.greatest(F.lit(5).cast("bigint"), F.floor(F.col("n_dates") / 50)) if min_spacing is None else F.lit(min_spacing).cast("bigint")
    )
    first = rows.where(F.col(POS) == 0)
    blocks = F.floor(F.col("n_dates") / SIDE).alias("last_block")
    spacing = stage(first.select(PANEL, gap.alias("spacing"), blocks))
    none = spacing.withColumn("spacing", F.lit(0).cast("bigint"))
    inside = rows.where(
        (F.col(POS) >= F.floor(F.col("n_dates") * EDGE)) & (F.col(POS) < F.floor(F.col("n_dates") * (1 - EDGE))) & (F.col(POS) > 0)
    ).select(PANEL, POS, "c1", "c2")
    last = rows.where(F.col(POS) == F.col("n_dates") - 1)
    end = last.select(
        PANEL, F.col("n_dates").alias(POS), (F.col("c1") + F.col("z")).alias("c1"), (F.col("c2") + F.col("z") * F.col("z")).alias("c2")
    )
    begin = first.select(PANEL, POS, F.lit(0.0).alias("c1"), F.lit(0.0).alias("c2"), F.lit(0.0).alias("value"))
    state, rounds = begin, []
    for k in range(n_regimes - 1):
        found = stage(_extend(state, inside, spacing if k else none))
        rounds.append(found)
        state = inside.join(found.select(PANEL, POS, "value"), [PANEL, POS])
    closed = stage(_extend(state, end, none))
    # back from the end: a row per panel and round
    at = closed.select(PANEL, F.col("opened").alias(POS))
    changes = []
    for found in reversed(rounds):
        changes.append(at)
        at = at.join(found, [PANEL, POS]).select(PANEL, F.col("opened").alias(POS))
    marked = at.where("false")
    for c in changes:
        marked = marked.unionByName(c)
    marked = stage(marked.select(PANEL, POS, F.lit(True).alias("found")))
    for found in rounds:
        release(found)
    out = rows.join(marked, [PANEL, POS], "left")
    evidence = closed.select(PANEL, F.col("value").alias("log_evidence"))
    out = with_figures(out, spacing.select(PANEL).join(evidence, PANEL, "left"), [PANEL])
    return out.select(PANEL, TS, POS, "n_dates", F.col("found").isNotNull().alias("is_change"), "log_evidence")
