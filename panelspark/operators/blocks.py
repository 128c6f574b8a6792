"""Time positions, bounded blocks and two-level scans.

A series can be arbitrarily long and one series can hold a large share of all rows, so no
operator sorts a whole series in one task. Instead:

* every date gets its 0-based position in the panel calendar (``positions``);
* a series is cut in blocks of ``block_rows`` positions. A block also receives the few rows
  before it that its windows reach back to (the halo), is processed alone and then loses the
  halo again (``series_blocks``, ``padded_grid``);
* unbounded frames (running sum, forward fill) combine a scan inside each block with a scan
  over one summary row per block (``running``);
* ranks and exact quantiles are taken inside value ranges whose counts are prefix-summed
  (``value_ranks``, ``quantiles``).

Windows count *panel dates*, so frames are ranges over ``pos``: absent rows then behave like
the empty cells of a dense Date x Asset table without having to exist.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.schema import PANEL, POS, PRICE, SERIES, SYMBOL, TS, require
from panelspark.session import stage

BLOCK_ROWS = 16_384
RANGE_ROWS = 500_000
BLOCK = "block"


def _time_slice(df: DataFrame) -> Column:
    """A calendar slice holding few distinct stamps: a year of dates or an hour of stamps."""
    unit = "year" if isinstance(df.schema[TS].dataType, T.DateType) else "hour"
    return F.date_trunc(unit, F.col(TS))


def panel_calendar(df: DataFrame, keys: Sequence[str] = (PANEL,)) -> DataFrame:
    """Distinct stamps per panel with ``pos`` (0-based) and ``n_dates``; sorted per slice only.

    A table that already carries positions is only reduced to its distinct dates.
    """
    keys = list(keys)
    if {POS, "n_dates"} <= set(df.columns):
        return df.groupBy(*keys, TS, POS, "n_dates").agg(F.lit(1).alias("_one")).drop("_one")
    stamps = df.select(*keys, TS, _time_slice(df).alias("slice")).groupBy(*keys, "slice").agg(
        F.array_sort(F.collect_set(TS)).alias("stamps")
    )
    by_slice = Window.partitionBy(*keys).orderBy("slice")
    offsets = stamps.select(*keys, "slice", F.size("stamps").cast("long").alias("n")).select(
        *keys,
        "slice",
        (F.sum("n").over(by_slice) - F.col("n")).alias("offset"),
        F.sum("n").over(Window.partitionBy(*keys)).alias("n_dates"),
    )
    return (
        stamps.join(offsets, [*keys, "slice"])
        .select(*keys, "offset", "n_dates", F.posexplode("stamps").alias("i", TS))
        .select(*keys, TS, (F.col("offset") + F.col("i")).alias(POS), "n_dates")
    )


def positions(df: DataFrame, keys: Sequence[str] = (PANEL,)) -> DataFrame:
    """Add ``pos`` and ``n_dates`` from the calendar of the rows at hand.

    Stored panels carry both, so that the calendar is built once; whatever removes dates
    drops them again (``without_positions``).
    """
    if {POS, "n_dates"} <= set(df.columns):
        return df
    df = without_positions(df)
    return df.join(panel_calendar(df, keys), [*keys, TS])


def without_positions(df: DataFrame) -> DataFrame:
    return df.drop(POS, "n_dates")


def _block_ids(halo: int, block_rows: int, last: Column | None = None) -> Column:
    """The block of a position, plus the next one when the row lies in that block's halo."""
    own = F.floor(F.col(POS) / block_rows)
    in_halo = F.col(POS) % block_rows >= block_rows - halo
    if last is not None:
        in_halo = in_halo & (own < last)
    return F.when(in_halo, F.array(own, own + 1)).otherwise(F.array(own))


def series_blocks(
    df: DataFrame,
    halo: int,
    keys: Sequence[str] = tuple(SERIES),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rows with ``block``; rows in the halo of the next block appear in both blocks."""
    block_rows = max(block_rows, halo)
    if halo == 0:
        return df.withColumn(BLOCK, F.floor(F.col(POS) / block_rows))
    last = F.floor((F.col("n_dates") - 1) / block_rows) if "n_dates" in df.columns else None
    return df.withColumn(BLOCK, F.explode(_block_ids(halo, block_rows, last)))


def core(df: DataFrame, halo: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Keep the rows a block owns; the halo copies belong to the block before."""
    block_rows = max(block_rows, halo)
    return df.where(F.col(POS) >= F.col(BLOCK) * block_rows).drop(BLOCK)


def spread(df: DataFrame, lo: Column, hi: Column, out: str) -> DataFrame:
    """One row for every position from ``lo`` to ``hi``, in steps, so that a gap of any length
    never becomes one array."""
    stepped = df.where(lo <= hi).withColumn("_hi", hi).withColumn(
        "_lo", F.explode(F.sequence(lo, hi, F.lit(BLOCK_ROWS).cast("bigint")))
    )
    until = F.least(F.col("_lo") + BLOCK_ROWS - 1, F.col("_hi"))
    return stepped.withColumn(out, F.explode(F.sequence("_lo", until))).drop("_lo", "_hi")


def block_window(keys: Sequence[str] = tuple(SERIES)) -> WindowSpec:
    return Window.partitionBy(*keys, BLOCK).orderBy(POS)


def shift(c: Column, k: int, w: WindowSpec) -> Column:
    """Value ``k`` panel dates earlier, NULL when that date is absent."""
    return F.max(c).over(w.rangeBetween(-k, -k))


def full(c: Column, size: int, w: WindowSpec, agg: Column) -> Column:
    """``agg`` over the last ``size`` panel dates, NULL unless all of them carry a value."""
    frame = w.rangeBetween(-(size - 1), 0)
    return F.when(F.count(c).over(frame) == size, agg.over(frame))


def padded_grid(
    bars: DataFrame,
    halo: int,
    values: Sequence[str] = (PRICE,),
    pad: str = PRICE,
    block_rows: int = BLOCK_ROWS,
    with_stamps: bool = True,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """Blocked rows for *every* panel date from a symbol's first value on.

    Gaps are filled by letting each row stand for the positions up to the next one, so no
    symbol x date product is formed. ``<pad>_pad`` holds the last known value; a block starts
    with a seed row that carries the last value from before its halo.
    """
    require(bars, PANEL, SYMBOL, TS, *values)
    block_rows = max(block_rows, halo + 1)
    calendar = panel_calendar(bars) if calendar is None else calendar
    present = F.coalesce(*[F.col(v) for v in values]).isNotNull()
    if not {POS, "n_dates"} <= set(bars.columns):
        bars = without_positions(bars).join(calendar, [PANEL, TS])
    obs = bars.where(present).select(*SERIES, TS, POS, "n_dates", *values)
    last_block = F.floor((F.col("n_dates") - 1) / block_rows)

    rows = obs.select(
        *SERIES,
        F.explode(_block_ids(halo, block_rows, last_block)).alias(BLOCK),
        POS,
        "n_dates",
        *values,
        F.lit(1).alias("real"),
    )
    ends = obs.groupBy(
        *SERIES, F.floor((F.col(POS) + halo) / block_rows).alias("reach")
    ).agg(
        F.max_by(F.col(pad), F.when(F.col(pad).isNotNull(), F.col(POS))).alias("tail"),
        F.max("n_dates").alias("n_dates"),
    )
    by_reach = Window.partitionBy(*SERIES).orderBy("reach")
    seeds = (
        ends.select(
            *SERIES,
            "n_dates",
            F.last("tail", ignorenulls=True).over(by_reach).alias("tail"),
            (F.col("reach") + 1).alias("lo"),
            F.coalesce(F.lead("reach").over(by_reach), last_block).alias("hi"),
        )
        .where(F.col("lo") <= F.col("hi"))
        .select(
            *SERIES,
            F.explode(F.sequence("lo", "hi")).alias(BLOCK),
            "n_dates",
            "tail",
        )
        .select(
            *SERIES,
            BLOCK,
            (F.col(BLOCK) * block_rows - halo).alias(POS),
            "n_dates",
            *[
                (F.col("tail") if v == pad else F.lit(None).cast("double")).alias(v)
                for v in values
            ],
            F.lit(0).alias("real"),
        )
    )
    w = Window.partitionBy(*SERIES, BLOCK).orderBy(POS, "real")
    until = F.least((F.col(BLOCK) + 1) * block_rows, F.col("n_dates"))
    spans = (
        rows.unionByName(seeds)
        .withColumn("until", F.coalesce(F.lead(POS).over(w), until))
        .withColumn(f"{pad}_pad", F.last(pad, ignorenulls=True).over(w))
        .where(F.col("until") > F.col(POS))
    )
    own = (F.col("grid_pos") == F.col(POS)) & (F.col("real") == 1)
    grid = spans.withColumn(
        "grid_pos", F.explode(F.sequence(F.col(POS), F.col("until") - 1))
    ).select(
        *SERIES,
        BLOCK,
        F.col("grid_pos").alias(POS),
        "n_dates",
        *[F.when(own, F.col(v)).alias(v) for v in values],
        f"{pad}_pad",
    )
    if with_stamps:
        grid = grid.join(calendar.select(PANEL, POS, TS), [PANEL, POS])
    return grid


def running(
    df: DataFrame,
    keys: Sequence[str],
    outputs: dict[str, tuple[str, Column]],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Unbounded frames along ``pos``: running ``sum``, ``max`` and ``last`` known value of the
    past, or the ``next`` known value, always with the current row. NULL inputs are skipped.

    Scans blocks alone, prefixes one summary row per block and joins it back.
    """
    keys = list(keys)
    scans = {
        "sum": F.sum,
        "max": F.max,
        "last": lambda c: F.last(c, ignorenulls=True),
        "next": lambda c: F.last(c, ignorenulls=True),
    }
    base = df.withColumn("_b", F.floor(F.col(POS) / block_rows))
    order = {k: F.desc(POS) if k == "next" else F.asc(POS) for k in scans}

    def past(kind: str) -> WindowSpec:
        w = Window.partitionBy(*keys, "_b").orderBy(order[kind])
        return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    whole = Window.partitionBy(*keys, "_b").orderBy(POS).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    local = base.select(
        *df.columns,
        "_b",
        *[scans[kind](c).over(past(kind)).alias(f"_l_{n}") for n, (kind, c) in outputs.items()],
        *[
            F.first(c, ignorenulls=True).over(whole).alias(f"_w_{n}")
            for n, (kind, c) in outputs.items()
            if kind == "next"
        ],
        F.lead(POS).over(Window.partitionBy(*keys, "_b").orderBy(POS)).isNull().alias("_end"),
    )

    def prior(kind: str, name: str) -> Column:
        w = Window.partitionBy(*keys).orderBy(F.desc("_b") if kind == "next" else F.asc("_b"))
        summary = f"_w_{name}" if kind == "next" else f"_l_{name}"
        return scans[kind](F.col(summary)).over(w.rowsBetween(Window.unboundedPreceding, -1))

    carry = local.where("_end").select(
        *keys, "_b", *[prior(kind, n).alias(f"_c_{n}") for n, (kind, _) in outputs.items()]
    )

    def combine(name: str, kind: str) -> Column:
        here, before = F.col(f"_l_{name}"), F.col(f"_c_{name}")
        if kind == "sum":
            total = F.coalesce(here, F.lit(0.0)) + F.coalesce(before, F.lit(0.0))
            return F.when(here.isNotNull() | before.isNotNull(), total)
        return F.greatest(here, before) if kind == "max" else F.coalesce(here, before)

    kept = [c for c in df.columns if c not in outputs]
    return local.join(carry, [*keys, "_b"]).select(
        *kept, *[combine(n, k).alias(n) for n, (k, _) in outputs.items()]
    )


def figure_block(df: DataFrame) -> Column:
    """The stretch of time of a row: of positions if it has them, else of its stamps; one of 64 lots without both."""
    if POS in df.columns:
        return F.floor(F.col(POS) / BLOCK_ROWS)
    if TS not in df.columns:
        return F.pmod(F.xxhash64(*df.columns), F.lit(64))
    kind = df.schema[TS].dataType
    if isinstance(kind, T.DateType):
        return F.floor(F.unix_date(TS) / BLOCK_ROWS)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.floor(F.unix_micros(F.col(TS).cast("timestamp")) / (BLOCK_ROWS * 60_000_000))
    return F.floor(F.col(TS) / BLOCK_ROWS)


def figures(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """One row of aggregates per key, with the blocks its rows lie in; pre-aggregated where the rows are."""
    blocks = F.collect_set("_block").alias("_blocks")
    return df.withColumn("_block", figure_block(df)).groupBy(*keys).agg(*aggregates, blocks)


def with_figures(df: DataFrame, figures_: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Rows joined to the one row of figures of their key, by (key, block).

    The figures are repeated for every block that has rows of their key, so a panel or a symbol with most
    of all rows is dealt over as many tasks as it has blocks, whatever the engine knows about skew.
    """
    keys = list(keys)
    if "_blocks" not in figures_.columns:
        figures_ = figures_.join(figures(df, keys), keys)
    spread_ = figures_.withColumn("_block", F.explode("_blocks")).drop("_blocks")
    return df.withColumn("_block", figure_block(df)).join(spread_, [*keys, "_block"], how).drop("_block")


def value_ranks(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    range_rows: int = RANGE_ROWS,
    ranges: int = 256,
) -> DataFrame:
    """Per distinct value of each group: ``n_equal``, ``n_less`` and the group's ``n_total``.

    Values are counted first, so one repeated value is a single row. Groups of more than
    ``range_rows`` distinct values are split at approximate quantiles; every group is ranked
    range by range in the same plan, a small one as a single range. The ranks are exact
    wherever the edges fall. The counts are read three times, so they are a staged table.
    """
    keys = list(keys)
    counted = stage(
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("n_equal"))
    )
    whole = Window.partitionBy(*keys)
    sizes = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_distinct"))
    edges = (
        counted.join(sizes.where(F.col("n_distinct") > range_rows).select(*keys), keys)
        .groupBy(*keys)
        .agg(F.percentile_approx(value, [i / ranges for i in range(1, ranges)], 10_000).alias("edges"))
    )
    placed = counted.join(edges, keys, "left").select(
        *keys,
        value,
        "n_equal",
        F.coalesce(F.size(F.filter("edges", lambda e: e < F.col(value))), F.lit(0)).alias("range"),
    )
    by_range = whole.orderBy("range")
    offsets = (
        placed.groupBy(*keys, "range")
        .agg(F.sum("n_equal").alias("n"))
        .select(
            *keys,
            "range",
            (F.sum("n").over(by_range) - F.col("n")).alias("offset"),
            F.sum("n").over(whole).alias("n_total"),
        )
    )
    inside = Window.partitionBy(*keys, "range").orderBy(value)
    return placed.join(offsets, [*keys, "range"]).select(
        *keys,
        value,
        "n_equal",
        (F.col("offset") + F.sum("n_equal").over(inside) - F.col("n_equal")).alias("n_less"),
        "n_total",
    )


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: dict[str, float],
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Exact, linearly interpolated quantiles per group, one column per name."""
    keys = list(keys)
    ranked = value_ranks(df, keys, value, range_rows)
    lo, hi = F.col("n_less"), F.col("n_less") + F.col("n_equal")

    def at(rank: Column) -> Column:
        return F.max(F.when((lo <= rank) & (rank < hi), F.col(value)))

    out = []
    for name, p in probs.items():
        h = (F.col("n_total") - 1) * F.lit(p)
        below, above = at(F.floor(h)), at(F.ceil(h))
        out.append((below + (above - below) * F.max(h - F.floor(h))).alias(name))
    return ranked.groupBy(*keys).agg(*out)
