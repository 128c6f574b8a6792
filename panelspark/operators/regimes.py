"""Regime labels from volatility quantiles and clustering, and what regimes look like."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.numeric import TRADING_DAYS, ratio, sample_kurtosis, sample_skew
from panelspark.operators.blocks import (
    BLOCK,
    BLOCK_ROWS,
    figures,
    positions,
    quantiles,
    running,
    series_blocks,
    with_figures,
)
from panelspark.operators.market import market_return, market_volatility, regime_features
from panelspark.operators.shape import matching_columns
from panelspark.schema import PANEL, POS, RET, TS
from panelspark.session import release, stage

# fixed values: names of the four volatility regimes
VOLATILITY_NAMES = ["Low Vol", "Normal", "High Vol", "Crisis"]


def one_hot_probs(regime: Column, k: int) -> Column:
    """Crisp labels as probabilities 0 and 1."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (i == regime).cast("double")
    )


def unpack_probs(df: DataFrame, k: int) -> DataFrame:
    """``probs`` as columns ``prob_regime_0`` .. for export."""
    return df.select(
        *[c for c in df.columns if c != "probs"],
        *[F.col("probs")[i].alias(f"prob_regime_{i}") for i in range(k)],
    )


def volatility_regimes(
    returns: DataFrame, window: int = 21, probs: Sequence[float] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """Market volatility binned at its own quantiles; a date without volatility is Normal."""
    vol = stage(market_volatility(returns, window))
    cuts = quantiles(vol, [PANEL], "volatility", {f"q{i}": p for i, p in enumerate(probs)})
    v = F.col("volatility")
    regime = (
        F.when(v > F.col("q2"), 3).when(v > F.col("q1"), 2).when(v <= F.col("q0"), 0).otherwise(1)
    )
    names = F.array(*[F.lit(n) for n in VOLATILITY_NAMES])
    return with_figures(vol, cuts, [PANEL], "left").select(
        PANEL,
        TS,
        regime.alias("regime"),
        "volatility",
        F.get(names, regime).alias("regime_name"),
        one_hot_probs(regime, 4).alias("probs"),
    )


#: Squared movement of a centre that only rounding explains.
STILL = 1e-24

# --- clustering -----------------------------------------------------------------------


def standardise(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (PANEL,)) -> DataFrame:
    """z-scores with the population deviation; a constant column becomes 0."""
    stats = figures(
        df,
        keys,
        *[F.avg(c).alias(f"_m_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"_s_{c}") for c in columns],
    )
    kept = [c for c in df.columns if c not in columns]

    def z(c: str) -> Column:
        s = F.when(F.col(f"_s_{c}") == 0, 1.0).otherwise(F.col(f"_s_{c}"))
        return ((F.col(c) - F.col(f"_m_{c}")) / s).alias(c)

    return with_figures(df, stats, keys).select(*kept, *[z(c) for c in columns])


def pca_fit(df: DataFrame, k: int, vector: str = "x") -> DataFrame:
    """Leading components per panel: ``component``, ``loadings``, ``explained``, ``centre``.

    Batches contribute their sums of products; a task solves one d x d matrix per panel.
    The sign makes the largest loading positive.
    """

    def partial(batches):
        for batch in batches:
            for panel, rows in batch.groupby(PANEL):
                x = np.stack(rows[vector].to_numpy())
                flat = np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])
                yield pd.DataFrame({PANEL: panel, "i": np.arange(len(flat)), "v": flat})

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        flat = pdf.sort_values("i")["v"].to_numpy()
        d = int((np.sqrt(4 * len(flat) - 3) - 1) / 2)
        n, mean = flat[0], flat[1 : d + 1] / flat[0]
        cov = flat[d + 1 :].reshape(d, d) / n - np.outer(mean, mean)
        values, vectors = np.linalg.eigh(cov)
        order = np.argsort(values)[::-1][:k]
        loads = vectors[:, order].T
        peak = np.abs(loads).argmax(axis=1)
        loads = loads * np.sign(loads[np.arange(len(order)), peak])[:, None]
        return pd.DataFrame(
            {
                PANEL: pdf[PANEL].iloc[0],
                "component": np.arange(len(order)),
                "loadings": list(loads),
                "explained": values[order] / values.sum(),
                "centre": [mean] * len(order),
            }
        )

    sums = df.select(PANEL, vector).mapInPandas(partial, f"{PANEL} string, i int, v double")
    return (
        sums.groupBy(PANEL, "i")
        .agg(F.sum("v").alias("v"))
        .groupBy(PANEL)
        .applyInPandas(
            solve,
            f"{PANEL} string, component int, loadings array<double>, explained double, centre array<double>",
        )
    )


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def pca_project(df: DataFrame, model: DataFrame, vector: str = "x") -> DataFrame:
    """Replace the vector by its coordinates on the components."""
    axes = model.groupBy(PANEL).agg(
        F.array_sort(F.collect_list(F.struct("component", "loadings", "centre"))).alias("_axes")
    )
    shifted = F.zip_with(F.col(vector), F.col("_axes")[0]["centre"], lambda x, m: x - m)
    coords = F.transform("_axes", lambda a: _dot(shifted, a["loadings"]))
    return with_figures(df, axes, [PANEL]).withColumn(vector, coords).drop("_axes")


def _distances(x: str, centres: str, k: int) -> Column:
    """Distance to each of ``k`` centres; NULL where a panel has fewer."""
    squares = lambda c: F.zip_with(F.col(x), c, lambda a, b: (a - b) * (a - b))
    return F.transform(
        F.array(*[F.get(F.col(centres), F.lit(j)) for j in range(k)]),
        lambda c: F.sqrt(F.aggregate(squares(c), F.lit(0.0), lambda s, v: s + v)),
    )


def _nearest(distances: Column) -> Column:
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def kmeans_fit(
    points: DataFrame,
    k: int = 4,
    dims: int = 3,
    restarts: int = 10,
    max_iter: int = 50,
    tol: float = 1e-9,
    seed: int = 42,
) -> DataFrame:
    """Centres per panel (``centres`` array of vectors) of the best of several restarts, with its ``inertia``,
    ``converged`` (no centre of that restart moved more than ``tol``, squared, in the last round) and ``rounds``.

    All panels and restarts advance in the same job: assignments are narrow, a task sends the sums of its
    points per centre, and only the movement of the centres is looked at. Points are kept as stretches of
    coordinates, so that a round is array arithmetic; a restart whose centres stand still waits for the others.
    """
    points = stage(points.select(PANEL, TS, "x"))
    starts = points.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))))
    lot = F.xxhash64(F.lit(seed), F.col(PANEL), F.col(TS).cast("string"), F.col("r"))
    first = (
        starts.withColumn("j", F.pmod(lot, F.lit(k)).cast("int"))
        .groupBy(PANEL, "r", "j")
        .agg(F.min_by("x", F.xxhash64(lot)).alias("c"))
    )

    def pack(rows: DataFrame, *more: Column) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct("j", "c")))
        return rows.groupBy(PANEL, "r").agg(
            F.transform(ordered, lambda s: s["c"]).alias("centres"), *more
        )

    centres = stage(pack(first, F.lit(None).cast("double").alias("moved")))
    moved = F.aggregate(
        F.zip_with("old", "c", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v
    )
    still = F.coalesce(F.col("moved") <= STILL, F.lit(False))
    stretches = stage(_stretches(points, dims))
    mean = F.array(*[F.sum(F.col("total")[i]) / F.sum("n") for i in range(dims)]).alias("new")
    rounds = 0
    for _ in range(max_iter):
        rounds += 1
        means = _nearest_sums(stretches, centres.where(~still), k, dims).groupBy(PANEL, "r", "j").agg(mean)
        old = centres.select(
            PANEL, "r", F.when(still, F.col("moved")).alias("before"), F.posexplode("centres").alias("j", "old")
        )
        # what stands still has no new means and stays as it is
        step = old.join(means, [PANEL, "r", "j"], "left").withColumn("c", F.coalesce("new", "old"))
        last, centres = centres, stage(pack(step, F.coalesce(F.max("before"), F.max(moved)).alias("moved")))
        release(last)
        if centres.agg(F.max("moved")).first()[0] <= tol:
            break
    inertia = _nearest_sums(stretches, centres, k, dims).groupBy(PANEL, "r").agg(F.sum("inertia").alias("inertia"))
    scored = centres.join(inertia, [PANEL, "r"])
    best = F.struct("inertia", "r")
    return scored.groupBy(PANEL).agg(
        F.min_by("centres", best).alias("centres"),
        F.min("inertia").alias("inertia"),
        F.min_by(F.col("moved") <= tol, best).alias("converged"),
        F.lit(rounds).alias("rounds"),
    )


def _stretches(points: DataFrame, dims: int) -> DataFrame:
    """(panel, xs): the coordinates of the points of a panel that lie together, one after the other.

    Points with an absent coordinate are near no centre and left out.
    """
    xs = [F.get("x", F.lit(i)) for i in range(dims)]
    whole = points.where(F.col(PANEL).isNotNull()).select(PANEL, *[c.alias(f"x{i}") for i, c in enumerate(xs)]).dropna()

    def run(batches):
        for batch in batches:
            for panel, rows in batch.groupby(PANEL):
                yield pd.DataFrame({PANEL: [panel], "xs": [rows[[f"x{i}" for i in range(dims)]].to_numpy().ravel()]})

    return whole.mapInPandas(run, f"{PANEL} string, xs array<double>")


def _nearest_sums(stretches: DataFrame, centres: DataFrame, k: int, dims: int) -> DataFrame:
    """Per stretch, restart and centre ``j``: number, coordinate sums and inertia of the points nearest to it.

    Nearness is that of ``_distances``; absent centres are nearest to none, ties go to the first.
    """
    value = lambda j, i: F.coalesce(F.get(F.get("centres", F.lit(j)), F.lit(i)), F.lit(float("nan")))
    flat = F.array(*[value(j, i) for j in range(k) for i in range(dims)])
    packed = centres.groupBy(PANEL).agg(F.sort_array(F.collect_list(F.struct("r", flat.alias("c")))).alias("cs"))
    joined = stretches.join(packed.select(PANEL, F.col("cs.r").alias("rs"), F.flatten("cs.c").alias("cs")), PANEL)

    def run(batches):
        for batch in batches:
            out = []
            for panel, xs, rs, cs in zip(*(batch.column(c) for c in (PANEL, "xs", "rs", "cs"))):
                x = xs.values.to_numpy(zero_copy_only=False).reshape(-1, dims)
                c = cs.values.to_numpy(zero_copy_only=False).reshape(-1, k, dims)
                for r, own in zip(rs.as_py(), c):
                    d = np.zeros((k, len(x)))
                    for i in range(dims):
                        gap = x[:, i] - own[:, i, None]
                        d += gap * gap
                    d = np.sqrt(d)
                    d[np.isnan(d)] = np.inf
                    j = d.argmin(axis=0)
                    n = np.bincount(j, minlength=k)
                    total = np.stack([np.bincount(j, x[:, i], k) for i in range(dims)], axis=1)
                    least = d[j, np.arange(len(x))]
                    inertia = np.bincount(j, least * least, k)
                    out += [(panel.as_py(), r, a, int(n[a]), total[a], inertia[a]) for a in np.flatnonzero(n).tolist()]
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.float64())
            columns = zip(*out) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(columns, kinds)], names=[PANEL, "r", "j", "n", "total", "inertia"]
            )

    return joined.select(PANEL, "xs", "rs", "cs").mapInArrow(
        run, f"{PANEL} string, r int, j int, n long, total array<double>, inertia double"
    )


def inverse_distance_probs(distances: Column) -> Column:
    """1 / (distance + 1e-10), normalised to 1."""
    inverse = F.transform(distances, lambda d: 1.0 / (d + 1e-10))
    total = F.aggregate(inverse, F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0)))
    return F.transform(inverse, lambda v: v / total)


def assign_clusters(points: DataFrame, centres: DataFrame, k: int, dims: int) -> DataFrame:
    """Nearest centre and inverse-distance probabilities."""
    return (
        with_figures(points, centres.select(PANEL, "centres"), [PANEL])
        .withColumn("d", _distances("x", "centres", k))
        .select(
            *points.columns,
            _nearest(F.col("d")).alias("regime"),
            inverse_distance_probs(F.col("d")).alias("probs"),
        )
    )


def relabel(df: DataFrame, by: str) -> DataFrame:
    """Renumber regimes by the ascending mean of a column, probabilities included."""
    order = df.groupBy(PANEL, "regime").agg(F.avg(by).alias("level"))
    new = F.row_number().over(Window.partitionBy(PANEL).orderBy("level", "regime")) - 1
    ranks = order.withColumn("new", new)
    perm = ranks.groupBy(PANEL).agg(
        F.array_sort(F.collect_list(F.struct("new", "regime"))).alias("perm")
    )
    out = df.join(ranks.select(PANEL, "regime", "new"), [PANEL, "regime"]).join(perm, PANEL)
    moved = F.transform("perm", lambda p: F.col("probs")[p["regime"]])
    return out.withColumn("probs", moved).withColumn("regime", F.col("new")).drop("new", "perm")


# fixed values: name fragments that mark a feature as one of these kinds
NAME_PATTERNS = {
    "return": ["return", "pct_change"],
    "volatility": ["vol", "std"],
    "correlation": ["corr"],
    "dispersion": ["dispersion"],
}


def _middle(columns: list[Column]) -> Column:
    """Median of a handful of columns, skipping NULLs."""
    if len(columns) == 1:
        return columns[0]
    values = F.array_sort(F.filter(F.array(*columns), lambda v: v.isNotNull()))
    n = F.size(values)
    lo, hi = F.floor((n - 1) / 2).cast("int"), F.ceil((n - 1) / 2).cast("int")
    return (F.get(values, lo) + F.get(values, hi)) / 2


def cluster_regime_names(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Names per (panel, regime) from regime means against overall medians."""
    kinds = {k: matching_columns(columns, pats) for k, pats in NAME_PATTERNS.items()}
    used = sorted({c for k, cols in kinds.items() if k != "return" for c in cols})
    means = df.groupBy(PANEL, "regime").agg(*[F.avg(c).alias(c) for c in columns])
    if used:
        long = df.unpivot([PANEL], used, "feature", "value")
        medians = (
            quantiles(long, [PANEL, "feature"], "value", {"median": 0.5})
            .groupBy(PANEL)
            .pivot("feature", used)
            .agg(F.first("median"))
            .select(PANEL, *[F.col(c).alias(f"_q_{c}") for c in used])
        )
        means = means.join(medians, PANEL)

    def mean_of(kind: str) -> Column:
        return _middle([F.col(c) for c in kinds[kind]])

    def overall(kind: str) -> Column:
        return _middle([F.col(f"_q_{c}") for c in kinds[kind]])

    words = []
    if kinds["return"]:
        words.append(F.when(mean_of("return") > 0, "Bull").otherwise("Bear"))
    if kinds["volatility"]:
        calm = mean_of("volatility") < overall("volatility")
        words.append(F.when(calm, "Low Vol").otherwise("High Vol"))
    for kind, word in (("correlation", "High Corr"), ("dispersion", "High Disp")):
        if kinds[kind]:
            words.append(F.when(mean_of(kind) > overall(kind), word))
    name = F.concat_ws(" ", *words) if words else F.concat(F.lit("Regime "), F.col("regime"))
    return means.select(PANEL, "regime", name.alias("regime_name"))


def clustering_regimes(
    features: DataFrame,
    columns: Sequence[str] = ("market_return", "volatility", "correlation", "dispersion"),
    k: int = 4,
    components: int | None = 3,
    order_by: str | None = None,
    **fit: int,
) -> DataFrame:
    """Standardise, project, cluster, name; the features are kept beside the labels.

    ``features`` has one row per panel and date: ``regime_features`` of returns or any other.
    """
    features = stage(features.select(PANEL, TS, *columns))
    scaled = standardise(features, columns).select(
        PANEL, TS, F.array(*columns).alias("x")
    )
    dims = len(columns)
    if components is not None:
        dims = min(components, dims)
        scaled = pca_project(scaled, pca_fit(scaled, dims))
    points = stage(scaled)
    found = assign_clusters(points, kmeans_fit(points, k, dims, **fit), k, dims).drop("x")
    level = order_by or next(
        (c for c in matching_columns(columns, NAME_PATTERNS["volatility"])), columns[0]
    )
    labelled = stage(relabel(found.join(features, [PANEL, TS]), level))
    names = cluster_regime_names(labelled, columns)
    return labelled.join(names, [PANEL, "regime"]).select(
        PANEL, TS, "regime", "regime_name", "probs", *columns
    )


def returns_clustering(returns: DataFrame, k: int = 4, **options: int) -> DataFrame:
    return clustering_regimes(regime_features(returns), k=k, **options)


def hmm_regime_names(df: DataFrame) -> DataFrame:
    """Bull or Bear by mean return, Low or High Vol against the overall median."""
    means = df.groupBy(PANEL, "regime").agg(
        F.avg("market_return").alias("m"), F.avg("volatility").alias("v")
    )
    median = quantiles(df, [PANEL], "volatility", {"q": 0.5})
    name = F.concat_ws(
        " ",
        F.when(F.col("m") > 0, "Bull").otherwise("Bear"),
        F.when(F.col("v") < F.col("q"), "Low Vol").otherwise("High Vol"),
    )
    return means.join(median, PANEL).select(PANEL, "regime", name.alias("regime_name"))


# --- what regimes look like -----------------------------------------------------------


def sign_regimes(returns: DataFrame) -> DataFrame:
    """1 on dates with a positive market return, else 0."""
    up = (F.col("market_return") > 0).cast("int")
    return market_return(returns).select(PANEL, TS, F.coalesce(up, F.lit(0)).alias("regime"))


def segments_to_regimes(df: DataFrame, n: int, change: str = "is_change") -> DataFrame:
    """Segment index modulo ``n``; a segment starts on a date flagged as a change."""
    flagged = positions(df)
    counted = running(flagged, [PANEL], {"segment": ("sum", F.coalesce(F.col(change).cast("double"), F.lit(0.0)))})
    regime = (F.col("segment") % n).cast("int")
    return counted.select(
        *df.columns,
        regime.alias("regime"),
        F.concat(F.lit("Regime "), regime + 1).alias("regime_name"),
        one_hot_probs(regime, n).alias("probs"),
    )


def regime_characteristics(regimes: DataFrame, returns: DataFrame) -> DataFrame:
    """Days, share, and moments of the market return per regime."""
    m = F.col("market_return")
    named = "regime_name" in regimes.columns
    name = F.col("regime_name") if named else F.concat(F.lit("Regime "), F.col("regime"))
    rows = regimes.select(PANEL, TS, "regime", name.alias("regime_name")).join(
        market_return(returns), [PANEL, TS]
    )
    year = F.sqrt(F.lit(float(TRADING_DAYS)))
    stats = rows.groupBy(PANEL, "regime").agg(
        F.min("regime_name").alias("regime_name"),
        F.count(F.lit(1)).alias("n_days"),
        F.avg(m).alias("mean_return"),
        (F.stddev_samp(m) * year).alias("volatility"),
        sample_skew(m).alias("skewness"),
        sample_kurtosis(m).alias("kurtosis"),
        F.max(m).alias("max_return"),
        F.min(m).alias("min_return"),
    )
    total = F.sum("n_days").over(Window.partitionBy(PANEL))
    return stats.withColumn("pct_days", F.col("n_days") / total * 100).withColumn(
        "sharpe_ratio", ratio(F.col("mean_return") * TRADING_DAYS, F.col("volatility"))
    )


def next_regime(regimes: DataFrame) -> DataFrame:
    """Each date's regime with the one before it on the panel's previous regime date.

    Dates are matched by position, block by block.
    """
    placed = positions(regimes.select(PANEL, TS, "regime"))
    blocks = series_blocks(placed, 1, [PANEL])
    w = Window.partitionBy(PANEL, BLOCK).orderBy(POS)
    return (
        blocks.withColumn("previous", F.lag("regime").over(w))
        .where(F.col(POS) >= F.col(BLOCK) * BLOCK_ROWS)
        .select(PANEL, TS, POS, "n_dates", "previous", "regime")
    )


def transition_matrix(regimes: DataFrame) -> DataFrame:
    """P(to | from) for every pair of labels that occur; a label never left has zeros."""
    counts = (
        next_regime(regimes)
        .where(F.col("previous").isNotNull())
        .groupBy(PANEL, F.col("previous").alias("from_regime"), F.col("regime").alias("to_regime"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    labels = regimes.groupBy(PANEL).agg(F.array_sort(F.collect_set("regime")).alias("labels"))
    pairs = labels.select(PANEL, "labels", F.explode("labels").alias("from_regime")).select(
        PANEL, "from_regime", F.explode("labels").alias("to_regime")
    )
    n = F.coalesce("n", F.lit(0))
    row = F.sum(n).over(Window.partitionBy(PANEL, "from_regime"))
    return pairs.join(counts, [PANEL, "from_regime", "to_regime"], "left").select(
        PANEL,
        "from_regime",
        "to_regime",
        F.coalesce(ratio(n.cast("double"), row.cast("double")), F.lit(0.0)).alias("probability"),
    )


def regime_frequencies(regimes: DataFrame) -> DataFrame:
    """Share of dates per regime."""
    counts = regimes.groupBy(PANEL, "regime").agg(F.count(F.lit(1)).alias("n_days"))
    return counts.withColumn(
        "probability", F.col("n_days") / F.sum("n_days").over(Window.partitionBy(PANEL))
    )


def regime_runs(regimes: DataFrame) -> DataFrame:
    """Uninterrupted stretches of one regime: start, length."""
    steps = next_regime(regimes).withColumn(
        "turn",
        F.when(F.col("previous").isNull() | (F.col("previous") != F.col("regime")), 1.0).otherwise(0.0),
    )
    runs = running(steps, [PANEL], {"run": ("sum", F.col("turn"))})
    return runs.groupBy(PANEL, F.col("run").cast("long").alias("run")).agg(
        F.min("regime").alias("regime"),
        F.min(TS).alias("start"),
        F.count(F.lit(1)).alias("length"),
    )


def mean_run_length(regimes: DataFrame) -> DataFrame:
    return regime_runs(regimes).groupBy(PANEL).agg(
        F.count(F.lit(1)).alias("n_runs"), F.avg("length").alias("mean_length")
    )
