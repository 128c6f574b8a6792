"""One query per operator over the derived panels, rounded for comparison."""

from __future__ import annotations

import datetime as dt
import io
import uuid
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.numeric import rounded
from panelspark.operators import features as feat
from panelspark.operators import indicators as ind
from panelspark.operators import (
    backtest,
    changepoint,
    hmm,
    market,
    portfolio,
    quality,
    regimes,
    segmentation,
    shape,
)
from panelspark.operators.blocks import positions
from panelspark.schema import PANEL, POS, SYMBOL, TS
from panelspark.session import shared_dir
from panelspark.sources import dimensions, ingest, readers, writers
from panelspark.sources.derived import Panels

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
BENCH = "A_F"


def query(name: str, digits: int = 6, drop: tuple[str, ...] = (PANEL, POS, "n_dates"), **overrides: int):
    """Register a function of the panels; its doubles are rounded, bookkeeping is dropped."""

    def register(build: Callable[[Panels], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = build(Panels(spark, folder))
            return rounded(df.drop(*[c for c in drop if c in df.columns]), digits, **overrides)

        _QUERIES[name] = run
        return build

    return register


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- indicators -----------------------------------------------------------------------


@query("d01_returns")
def _(p: Panels) -> DataFrame:
    return ind.returns(p.flag_d)


@query("d02_log_return")
def _(p: Panels) -> DataFrame:
    return ind.log_return(p.flag_d)


@query("d03_sma", 4)
def _(p: Panels) -> DataFrame:
    return ind.sma(p.flag_d)


@query("d04_ema", 4)
def _(p: Panels) -> DataFrame:
    return ind.ema(p.flag_d)


@query("d05_rsi", 4)
def _(p: Panels) -> DataFrame:
    return ind.rsi(p.flag_d)


@query("d06_macd", 4)
def _(p: Panels) -> DataFrame:
    return ind.macd(p.flag_d)


@query("d07_bollinger", bb_upper=4, bb_lower=4)
def _(p: Panels) -> DataFrame:
    return ind.bollinger(p.flag_d)


@query("d08_atr", 4)
def _(p: Panels) -> DataFrame:
    return ind.atr(p.flag_d)


@query("d09_momentum")
def _(p: Panels) -> DataFrame:
    return ind.momentum(p.flag_d)


@query("d10_volatility")
def _(p: Panels) -> DataFrame:
    return ind.volatility(p.flag_d)


@query("d11_rolling_correlation")
def _(p: Panels) -> DataFrame:
    return ind.rolling_correlation(p.flag_d, BENCH)


_COARSE = ("sma_20", "sma_50", "sma_200", "ema_12", "ema_26", "ema_50", "rsi_14", "macd", "macd_signal", "macd_hist", "bb_upper", "bb_lower", "atr_14")


@query("d12_all_indicators", **dict.fromkeys(_COARSE, 4))
def _(p: Panels) -> DataFrame:
    return ind.all_indicators(p.flag_d, BENCH)


@query("entry_features", sma_20=4, sma_50=4)
def _(p: Panels) -> DataFrame:
    daily = ind.all_windowed(p.flag_d, (1, 5), (20, 50), (20, 60))
    return feat.cs_zscore(daily, "return_daily")


# --- sources and sinks ----------------------------------------------------------------


def _scratch(p: Panels, name: str) -> str:
    return f"{shared_dir(p.spark)}/queries/{uuid.uuid4().hex}/{name}"


def _brands(p: Panels) -> list[str]:
    """Column list of a wide export: the distinct brands of the part dimension."""
    return sorted(r[0] for r in p.table("part").select("p_brand").distinct().collect())


@query("a01_read_wide_panel")
def _(p: Panels) -> DataFrame:
    path = _scratch(p, "asset_prices")
    wide = shape.to_wide(p.brand_w, "price", _brands(p)).drop(PANEL)
    wide.write.option("header", True).csv(path)
    return readers.read_wide_panel(p.spark, path)


@query("a02_read_indicators", 4)
def _(p: Panels) -> DataFrame:
    path = _scratch(p, "macro_data")
    series = [r[0] for r in p.macro_m.select("series_id").distinct().collect()]
    wide = p.macro_m.groupBy(TS).pivot("series_id", sorted(series)).agg(F.first("value"))
    wide.write.option("header", True).csv(path)
    return readers.read_indicators(p.spark, path, "macro")


@query("a03_read_features")
def _(p: Panels) -> DataFrame:
    path = _scratch(p, "features")
    writers.write_features(ind.momentum(p.flag_d), path)
    late = F.col(TS) >= F.lit(dt.date(1998, 1, 1))
    return readers.read_features(p.spark, path, [SYMBOL, TS, "momentum_20"], late)


@query("a04_write_features")
def _(p: Panels) -> DataFrame:
    path = _scratch(p, "features_csv")
    writers.write_features(ind.log_return(p.flag_d), path, "csv")
    back = p.spark.read.option("header", True).csv(path)
    return back.select(SYMBOL, F.to_date(TS).alias(TS), F.col("log_return").cast("double"))


@query("a05_write_results")
def _(p: Panels) -> DataFrame:
    """Regimes and their transitions written and read back."""
    labelled = p.volatility_regimes
    paths = writers.write_results(
        _scratch(p, "results"),
        regimes_volatility=labelled.drop("probs"),
        transitions=regimes.transition_matrix(labelled),
    )
    back = p.spark.read.option("header", True).csv(paths["transitions"])
    days = readers.read_regimes(p.spark, paths["regimes_volatility"], ["regime"])
    count = days.groupBy(F.col("regime").alias("from_regime")).agg(F.count(F.lit(1)).alias("n_days"))
    return back.select(
        F.col("from_regime").cast("int"), F.col("to_regime").cast("int"), F.col("probability").cast("double")
    ).join(count, "from_regime")


@query("a06_ingest_by_key", drop=())
def _(p: Panels) -> DataFrame:
    """Brands and nations asked for; the store has files of brands only."""
    path = _scratch(p, "store")
    p.brand_w.select(SYMBOL, TS, "price").write.partitionBy(SYMBOL).csv(path)

    def parse(content: bytes):
        rows = pd.read_csv(io.BytesIO(content), names=["ts", "price"], chunksize=10_000)
        for piece in rows:
            piece["ts"] = pd.to_datetime(piece["ts"]).dt.date
            yield piece

    wanted = p.table("part").select(F.col("p_brand").alias(SYMBOL)).union(
        p.table("nation").select("n_name")
    )
    schema = T.StructType([T.StructField("ts", T.DateType()), T.StructField("price", T.DoubleType())])
    rows = ingest.ingest_files(wanted, path, parse, schema)
    return rows.groupBy(SYMBOL).agg(
        F.count("price").alias("n_rows"),
        F.avg("price").alias("mean_price"),
        F.count("error").alias("n_errors"),
    )


@query("a07_ingest_coverage", drop=())
def _(p: Panels) -> DataFrame:
    """Shipping dates on which no order came in."""
    wanted = p.table("lineitem").select(F.to_date("l_shipdate").alias("key"))
    return ingest.ingest_coverage(wanted, p.table("orders").select(F.to_date("o_orderdate").alias("key")), "key")


@query("a08_latest_snapshot", 4)
def _(p: Panels) -> DataFrame:
    path, today = _scratch(p, "pulls"), dt.date(2001, 1, 3)
    ingest.snapshot(p.flag_d.withColumn("price", F.col("price") * 2), path, today - dt.timedelta(days=1))
    ingest.snapshot(p.flag_d, path, today)
    return ingest.latest_snapshot(p.spark, path, today, 2).select(SYMBOL, TS, "price", "volume")


@query("a09_ingest_all", drop=())
def _(p: Panels) -> DataFrame:
    missing = _scratch(p, "no_such_file.csv")
    tables = ingest.ingest_all(
        {
            "prices": lambda: p.brand_w,
            "macro": lambda: p.macro_m,
            "sentiment": lambda: p.sentiment_d,
            "absent": lambda: readers.read_indicators(p.spark, missing, "absent"),
        }
    )
    counts = [
        df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.max(TS).alias("last"))
        for n, df in tables.items()
        if df is not None
    ]
    return counts[0].union(counts[1]).union(counts[2])


@query("a10_dim_asset", drop=())
def _(p: Panels) -> DataFrame:
    dim = p.table("part").groupBy(F.col("p_brand").alias(SYMBOL)).agg(
        F.max("p_type").alias("asset_class")
    )
    return dimensions.class_counts(p.brand_w, dim)


# --- shaping --------------------------------------------------------------------------


def _symbols(p: Panels) -> list[str]:
    """The panel's symbols: a handful of flags, which become columns."""
    return sorted(r[0] for r in p.flag_d.select(SYMBOL).distinct().collect())


def _day_closes(p: Panels) -> list[DataFrame]:
    close = lambda s: p.flag_d.where(F.col(SYMBOL) == s).select(PANEL, TS, F.col("price").alias(f"p_{s}"))
    return [close(s) for s in _symbols(p)]


@query("b01_align_outer")
def _(p: Panels) -> DataFrame:
    return reduce(shape.align_outer, _day_closes(p))


@query("b02_align_inner")
def _(p: Panels) -> DataFrame:
    return reduce(shape.align_inner, _day_closes(p))


@query("b03_densify")
def _(p: Panels) -> DataFrame:
    return shape.densify(p.flag_d)


@query("b04_to_wide")
def _(p: Panels) -> DataFrame:
    return shape.to_wide(p.flag_d, "price", _symbols(p))


@query("b05_select_features")
def _(p: Panels) -> DataFrame:
    return shape.select_features(ind.momentum(p.flag_d), ["momentum_[12]0"])


@query("b06_drop_duplicate_columns")
def _(p: Panels) -> DataFrame:
    left = p.flag_d.select(PANEL, SYMBOL, TS, "price", "high")
    return shape.align_outer(left, p.flag_d.select(PANEL, SYMBOL, TS, "high", "low"), [PANEL, SYMBOL, TS])


@query("b07_order_by_time")
def _(p: Panels) -> DataFrame:
    return shape.order_by_time(p.flag_d.select(PANEL, SYMBOL, TS, "price"))


@query("b08_top_k")
def _(p: Panels) -> DataFrame:
    return shape.top_k(
        p.flag_d.select(SYMBOL, TS, "price"), 5, [F.desc("price"), F.col(TS)], [SYMBOL]
    )


@query("b08_top_k_overall")
def _(p: Panels) -> DataFrame:
    return shape.top_k(p.flag_d.select(SYMBOL, TS, "price"), 10, [F.desc("price"), F.col(TS)])


@query("b09_feature_family_counts")
def _(p: Panels) -> DataFrame:
    wide = feat.build_features(p.flag_d, benchmark=BENCH, clean=False)
    return shape.feature_family_counts(wide.drop("n_dates", "price"))


@query("b10_complete_cases")
def _(p: Panels) -> DataFrame:
    return shape.complete_cases(p.returns_of("flag_d"))


# --- quality --------------------------------------------------------------------------


@query("c01_panel_profile")
def _(p: Panels) -> DataFrame:
    return quality.panel_profile(p.flag_d)


@query("c02_missing_pct")
def _(p: Panels) -> DataFrame:
    return quality.missing_pct(p.event_h)


def _shifted(p: Panels) -> DataFrame:
    """The events as they are include no negative value; centre them to get some."""
    return p.flag_d.withColumn("price", F.floor((F.col("price") - 1500) / 100).cast("double"))


@query("c03_negative_price_check")
def _(p: Panels) -> DataFrame:
    return quality.negative_price_check(_shifted(p))


@query("c04_zero_price_check")
def _(p: Panels) -> DataFrame:
    return quality.zero_price_check(_shifted(p))


@query("c05_extreme_return_check")
def _(p: Panels) -> DataFrame:
    return quality.extreme_return_check(p.flag_d)


@query("c06_validation_issues")
def _(p: Panels) -> DataFrame:
    return quality.validation_issues(_shifted(p))


# --- features -------------------------------------------------------------------------


@query("e01_lag_features")
def _(p: Panels) -> DataFrame:
    return feat.lag_features(ind.returns(p.flag_d, [1]), ["return_daily", "no_such_column"])


@query("e02_cs_rank")
def _(p: Panels) -> DataFrame:
    return feat.cs_rank(ind.returns(p.brand_w, [1]), "return_daily")


@query("e03_cs_zscore")
def _(p: Panels) -> DataFrame:
    return feat.cs_zscore(ind.returns(p.brand_w, [1]), "return_daily")


@query("e04_cs_deviation")
def _(p: Panels) -> DataFrame:
    return feat.cs_deviation(ind.returns(p.brand_w, [1]), "return_daily")


@query("e05_interactions", 3)
def _(p: Panels) -> DataFrame:
    wide = shape.align_inner(ind.sma(p.flag_d, [20]), ind.rsi(p.flag_d), [PANEL, SYMBOL, TS])
    return feat.interactions(wide, [("sma_20", "rsi_14"), ("sma_20", "nothing")]).drop("sma_20", "rsi_14")


@query("e06_remove_weekends")
def _(p: Panels) -> DataFrame:
    return feat.remove_weekends(p.flag_d).select(SYMBOL, TS, "price")


@query("e07_remove_holidays")
def _(p: Panels) -> DataFrame:
    return feat.remove_holidays(p.flag_d).select(SYMBOL, TS, "price")


def _with_monthly(p: Panels) -> DataFrame:
    """A dense price and a column with values on month starts only."""
    return shape.densify(p.flag_d).withColumn("monthly", F.when(F.day(TS) == 3, F.col("price")))


@query("e08_fill_sparse")
def _(p: Panels) -> DataFrame:
    return feat.fill_sparse(_with_monthly(p), ["price", "monthly"], skip_warmup=False)


@query("e09_impute_interpolate")
def _(p: Panels) -> DataFrame:
    return feat.impute_interpolate(shape.densify(p.flag_d), ["price"])


@query("e10_impute_ffill")
def _(p: Panels) -> DataFrame:
    return feat.impute_ffill(shape.densify(p.flag_d), ["price"])


@query("e11_impute_mean")
def _(p: Panels) -> DataFrame:
    return feat.impute_mean(shape.densify(p.flag_d), ["price"])


@query("e12_impute_median")
def _(p: Panels) -> DataFrame:
    return feat.impute_median(shape.densify(p.flag_d), ["price"])


@query("e13_empty_features")
def _(p: Panels) -> DataFrame:
    return feat.empty_features(ind.sma(p.brand_w, (20, 200, 340)), ["sma_20", "sma_200", "sma_340"])


@query("e14_drop_incomplete")
def _(p: Panels) -> DataFrame:
    return feat.drop_incomplete(shape.densify(p.flag_d), ["price"], "date")


@query("e14_drop_incomplete_rows")
def _(p: Panels) -> DataFrame:
    return feat.drop_incomplete(shape.densify(p.flag_d), ["price"], "row")


@query("e15_clean_features")
def _(p: Panels) -> DataFrame:
    return feat.clean_features(_with_monthly(p), ["price", "monthly"], skip_warmup=False)


def _series(df: DataFrame) -> list[str]:
    """Names of an indicator dimension: a handful of series."""
    return sorted(r[0] for r in df.select("series_id").distinct().collect())


@query("e16_join_exogenous", 4)
def _(p: Panels) -> DataFrame:
    return feat.join_exogenous(p.flag_d.select(PANEL, SYMBOL, TS), p.macro_m, _series(p.macro_m))


@query("e16_join_exogenous_reference", 4)
def _(p: Panels) -> DataFrame:
    dates = feat.remove_holidays(feat.remove_weekends(p.flag_d)).select(PANEL, SYMBOL, TS)
    return feat.join_exogenous(dates, p.macro_m, _series(p.macro_m), "reference")


_PRODUCTS = {"sma_20_x_ema_12": 2, "rsi_14_x_macd": 3}
_EXOGENOUS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "F", "O", "P")
_BUILT = {**dict.fromkeys((*_COARSE, *_EXOGENOUS), 4), **_PRODUCTS}


def _built(p: Panels, impute: str | None) -> DataFrame:
    macro, sentiment = (p.macro_m, _series(p.macro_m)), (p.sentiment_d, _series(p.sentiment_d))
    return feat.build_features(p.flag_d, macro, sentiment, benchmark=BENCH, impute=impute)


@query("e17_build_features", **_BUILT)
def _(p: Panels) -> DataFrame:
    return _built(p, "interpolate")


@query("e17_build_features_raw", **_BUILT)
def _(p: Panels) -> DataFrame:
    return _built(p, None)


# --- market series and moments --------------------------------------------------------


@query("f01_market_return")
def _(p: Panels) -> DataFrame:
    return market.market_return(p.complete_returns("brand_w"))


@query("f02_dispersion")
def _(p: Panels) -> DataFrame:
    return market.dispersion(p.complete_returns("brand_w"))


@query("f03_market_volatility")
def _(p: Panels) -> DataFrame:
    return market.market_volatility(p.complete_returns("brand_w"))


@query("f04_avg_pairwise_correlation")
def _(p: Panels) -> DataFrame:
    return market.avg_pairwise_correlation(p.complete_returns("brand_w"), tile=16)


@query("f05_regime_features")
def _(p: Panels) -> DataFrame:
    return market.regime_features(p.complete_returns("brand_w"))


@query("f06_covariance", 7)
def _(p: Panels) -> DataFrame:
    return market.covariance(p.returns_of("brand_w"))


@query("f07_correlation")
def _(p: Panels) -> DataFrame:
    return market.correlation(p.returns_of("brand_w"), tile=16, chunk=128)


@query("f08_annualised_moments", 5)
def _(p: Panels) -> DataFrame:
    mu, cov = market.annualised_moments(p.complete_returns("brand_w"))
    own = cov.where("sym_i = sym_j").select(PANEL, F.col("sym_i").alias(SYMBOL), F.col("cov").alias("variance"))
    return mu.join(own, [PANEL, SYMBOL])


def _sign_regimes(p: Panels) -> DataFrame:
    return regimes.sign_regimes(p.complete_returns("brand_w"))


@query("f09_moments_by_regime", 7)
def _(p: Panels) -> DataFrame:
    mu, cov = market.moments_by_regime(p.complete_returns("brand_w"), _sign_regimes(p))
    return cov.join(mu.withColumnRenamed(SYMBOL, "sym_i"), [PANEL, "regime", "sym_i"])


@query("f10_regime_feature_stats")
def _(p: Panels) -> DataFrame:
    columns = ["market_return", "volatility", "correlation", "dispersion"]
    return market.regime_feature_stats(p.regime_features, _sign_regimes(p), columns)


# --- regimes --------------------------------------------------------------------------


@query("g01_volatility_regimes")
def _(p: Panels) -> DataFrame:
    found = regimes.volatility_regimes(p.complete_returns("brand_w"))
    return regimes.unpack_probs(found, 4)


@query("g02_standardise")
def _(p: Panels) -> DataFrame:
    return regimes.standardise(p.regime_features, ["market_return", "volatility"]).select(
        TS, "market_return", "volatility"
    )


def _vectors(p: Panels) -> DataFrame:
    """The embedding table as one panel of vectors."""

    def build() -> DataFrame:
        return p.table("embeddings").select(
            F.lit("embeddings").alias(PANEL),
            F.col("vec_id").alias(TS),
            "label",
            F.col("embedding").cast("array<double>").alias("x"),
        )

    return p.stored("vectors", build)


@query("g03_pca")
def _(p: Panels) -> DataFrame:
    model = regimes.pca_fit(_vectors(p), 3)
    return model.select("component", "explained", F.array_max(F.transform("loadings", F.abs)).alias("peak"))


def _clusters(p: Panels) -> tuple[DataFrame, DataFrame]:
    """The embeddings on their first three components, and the centres fitted to them once."""

    def project() -> DataFrame:
        vectors = _vectors(p)
        return regimes.pca_project(vectors, regimes.pca_fit(vectors, 3))

    points = p.stored("projected", project)
    return points, p.stored("centres", lambda: regimes.kmeans_fit(points, k=4, dims=3, restarts=5))


@query("g04_kmeans_regimes")
def _(p: Panels) -> DataFrame:
    """Clusters of the embeddings on their first three components, and whether they have settled."""
    points, centres = _clusters(p)
    found = regimes.assign_clusters(points, centres, 4, 3)
    sizes = found.groupBy(PANEL, "regime").agg(F.count(F.lit(1)).alias("n_points"))
    return sizes.join(centres.select(PANEL, "converged", "rounds"), PANEL)


@query("g03_pca_checks")
def _(p: Panels) -> DataFrame:
    """What makes components principal: their coordinates don't correlate, and each holds its share of the variance."""
    vectors = _vectors(p)
    model = regimes.pca_fit(vectors, 3)
    coords = regimes.pca_project(vectors, model)
    shares = model.select(PANEL, "component", "explained", F.aggregate("loadings", F.lit(0.0), lambda s, v: s + v * v).alias("length"))
    total = vectors.select(PANEL, F.posexplode("x").alias("i", "v")).groupBy(PANEL, "i").agg(F.var_pop("v").alias("v"))
    total = total.groupBy(PANEL).agg(F.sum("v").alias("whole"))
    own = coords.select(PANEL, TS, F.posexplode("x").alias("component", "c")).groupBy(PANEL, "component").agg(F.var_pop("c").alias("own"))
    cross = coords.groupBy(PANEL).agg(
        *[F.corr(F.col("x")[i], F.col("x")[j]).alias(f"r{i}{j}") for i, j in ((0, 1), (0, 2), (1, 2))]
    )
    found = shares.join(own, [PANEL, "component"]).join(total, PANEL).join(cross, PANEL)
    return found.select(
        "component", "length", (F.col("own") / F.col("whole") - F.col("explained")).alias("share_off"),
        F.greatest(F.abs("r01"), F.abs("r02"), F.abs("r12")).alias("correlation"),
    )


@query("g04_kmeans_checks")
def _(p: Panels) -> DataFrame:
    """The centres of g04 have settled: one more step moves none, and every vector is in one cluster."""
    points, centres = _clusters(p)
    found = regimes.assign_clusters(points, centres, 4, 3)
    means = found.groupBy(PANEL, "regime").agg(
        F.array(*[F.avg(F.col("x")[i]) for i in range(3)]).alias("mean"), F.count(F.lit(1)).alias("n")
    )
    moved = F.aggregate(
        F.zip_with("mean", F.get("centres", F.col("regime")), lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, v: F.greatest(s, v)
    )
    return means.join(centres, PANEL).groupBy(PANEL).agg(F.max(moved).alias("moved"), F.sum("n").alias("n_points"), F.count(F.lit(1)).alias("k"))


@query("g05_inverse_distance_probs")
def _(p: Panels) -> DataFrame:
    """Distances of all components to the mean vectors of all labels."""
    points = _vectors(p).select(PANEL, F.col(TS).alias("vec_id"), "label", "x")
    means = points.where("label is not null").groupBy(PANEL, "label").agg(
        F.array(*[F.avg(F.col("x")[i]) for i in range(64)]).alias("c")
    )
    centres = means.groupBy(PANEL).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("label", "c"))), lambda s: s["c"]).alias("centres")
    )
    found = regimes.assign_clusters(points, centres, 10, 64)
    return regimes.unpack_probs(found.select("vec_id", "regime", "probs"), 10)


@query("g06_cluster_regime_names")
def _(p: Panels) -> DataFrame:
    columns = ["market_return", "volatility", "correlation", "dispersion"]
    labelled = p.regime_features.join(p.volatility_regimes.select(PANEL, TS, "regime"), [PANEL, TS])
    return regimes.cluster_regime_names(labelled, columns)


@query("g07_clustering_regimes")
def _(p: Panels) -> DataFrame:
    found = regimes.clustering_regimes(p.regime_features)
    return regimes.unpack_probs(found, 4)


def _states(p: Panels) -> DataFrame:
    """A panel per symbol: its standardised return and size of move, one vector per date."""

    def build() -> DataFrame:
        each = p.complete_returns("brand_w").select(
            F.col(SYMBOL).alias(PANEL), TS, F.col("ret").alias("market_return"), F.abs("ret").alias("volatility")
        )
        return hmm.vectors(each)

    return p.stored("hmm_points", build)


def _hmm(p: Panels) -> tuple[DataFrame, DataFrame]:
    """Those series and a model fitted to each."""
    points = _states(p)
    return points, p.stored("hmm_params", lambda: hmm.hmm_fit(points, 3, 2))


@query("g08_hmm_fit", drop=())
def _(p: Panels) -> DataFrame:
    return _hmm(p)[1]


@query("g09_hmm_viterbi", drop=())
def _(p: Panels) -> DataFrame:
    return hmm.hmm_viterbi(*_hmm(p), k=3)


@query("g10_hmm_posteriors", drop=())
def _(p: Panels) -> DataFrame:
    return regimes.unpack_probs(hmm.hmm_posteriors(*_hmm(p), k=3), 3)


@query("g11_hmm_log_likelihood", drop=("n_dates",))
def _(p: Panels) -> DataFrame:
    return hmm.hmm_log_likelihood(*_hmm(p), k=3)


#: A given model for the decoders, and the dates of a block, fewer than the series have.
GIVEN = {"pi": [0.6, 0.4], "a": [0.9, 0.1, 0.2, 0.8], "mu": [0.1, -0.4, -0.2, 0.7], "cov": [1.0, 0.0, 0.0, 0.5, 1.5, 0.0, 0.0, 1.2]}
GIVEN_BLOCK = 64


def _given(p: Panels) -> tuple[DataFrame, DataFrame]:
    """The same series and one model of two states for all of them, without fitting."""
    points = _states(p)
    columns = [F.array(*map(F.lit, v)).alias(k) for k, v in GIVEN.items()]
    return points, points.select(PANEL).distinct().select(PANEL, *columns, F.lit(None).cast("double").alias("ll"))


@query("g09_viterbi_given", drop=())
def _(p: Panels) -> DataFrame:
    return hmm.hmm_viterbi(*_given(p), k=2, block_rows=GIVEN_BLOCK)


@query("g10_posteriors_given", drop=())
def _(p: Panels) -> DataFrame:
    return regimes.unpack_probs(hmm.hmm_posteriors(*_given(p), k=2, block_rows=GIVEN_BLOCK), 2)


@query("g11_log_likelihood_given", drop=("n_dates",))
def _(p: Panels) -> DataFrame:
    return hmm.hmm_log_likelihood(*_given(p), k=2, block_rows=GIVEN_BLOCK)


@query("g12_hmm_regimes")
def _(p: Panels) -> DataFrame:
    """Fit, decode and name the states of the whole market."""
    return regimes.unpack_probs(hmm.hmm_regimes(p.complete_returns("brand_w"), 3), 3)


@query("g12_hmm_regime_names")
def _(p: Panels) -> DataFrame:
    labelled = p.regime_features.join(p.volatility_regimes.select(PANEL, TS, "regime"), [PANEL, TS])
    return regimes.hmm_regime_names(labelled)


def _big_moves(p: Panels) -> DataFrame:
    moves = market.market_return(p.complete_returns("brand_w"))
    return moves.select(PANEL, TS, (F.abs("market_return") > 0.15).alias("is_change"))


@query("g13_changepoint_posterior", 5)
def _(p: Panels) -> DataFrame:
    return changepoint.changepoint_posterior(
        market.dispersion(p.complete_returns("brand_w")), "dispersion"
    )


@query("g14_changepoints")
def _(p: Panels) -> DataFrame:
    series = market.dispersion(p.complete_returns("brand_w"))
    return changepoint.changepoints(series, "dispersion")


@query("g14_fixed_changes", 5)
def _(p: Panels) -> DataFrame:
    """The best three changes of dispersion, and what the whole segmentation is worth."""
    series = market.dispersion(p.complete_returns("brand_w"))
    return segmentation.fixed_changepoints(series, "dispersion", 4)


@query("g15_segments_to_regimes")
def _(p: Panels) -> DataFrame:
    return regimes.unpack_probs(regimes.segments_to_regimes(_big_moves(p), 3), 3)


@query("g16_one_hot_probs")
def _(p: Panels) -> DataFrame:
    labelled = p.volatility_regimes.select(TS, "regime")
    return regimes.unpack_probs(labelled.withColumn("probs", regimes.one_hot_probs(F.col("regime"), 4)), 4)


@query("g17_regime_characteristics", 5)
def _(p: Panels) -> DataFrame:
    return regimes.regime_characteristics(p.volatility_regimes, p.complete_returns("brand_w"))


@query("g18_transition_matrix")
def _(p: Panels) -> DataFrame:
    return regimes.transition_matrix(p.volatility_regimes)


@query("g19_regime_frequencies")
def _(p: Panels) -> DataFrame:
    return regimes.regime_frequencies(p.volatility_regimes)


@query("g20_regime_runs")
def _(p: Panels) -> DataFrame:
    return regimes.regime_runs(p.volatility_regimes)


@query("g20_mean_run_length")
def _(p: Panels) -> DataFrame:
    return regimes.mean_run_length(p.volatility_regimes)


@query("g21_sign_regimes")
def _(p: Panels) -> DataFrame:
    return _sign_regimes(p)


# --- portfolios -----------------------------------------------------------------------


def _moments(p: Panels) -> tuple[DataFrame, DataFrame]:
    """Mean and covariance of the weekly returns, with the panel as the problem."""
    rows = p.complete_returns("brand_w")
    return (
        market.mean_returns(rows).withColumnRenamed(PANEL, "problem_id"),
        p.brand_covariance.withColumnRenamed(PANEL, "problem_id"),
    )


def _strategies(p: Panels) -> DataFrame:
    """Three constant portfolios: equal, by mean price, and by inverse volatility."""
    level = p.brand_w.groupBy(PANEL, SYMBOL).agg(F.avg("price").alias("a"))
    total = level.groupBy(PANEL).agg(F.sum("a").alias("s"), F.count(F.lit(1)).alias("n"))
    both = level.join(total, PANEL)
    parity = portfolio.risk_parity(p.brand_covariance, [PANEL])
    return (
        both.select(PANEL, SYMBOL, F.lit("equal").alias("strategy"), (1 / F.col("n")).alias("weight"))
        .unionByName(both.select(PANEL, SYMBOL, F.lit("price").alias("strategy"), (F.col("a") / F.col("s")).alias("weight")))
        .unionByName(parity.select(PANEL, SYMBOL, F.lit("parity").alias("strategy"), "weight"))
    )


def _solved(p: Panels, weights: DataFrame) -> DataFrame:
    """Weights with the figures that show whether they are right."""
    mu, cov = _moments(p)
    return weights.join(portfolio.portfolio_stats(weights, mu, cov), "problem_id")


@query("h01_mean_variance")
def _(p: Panels) -> DataFrame:
    mu, cov = _moments(p)
    problems = portfolio.problem_rows(mu, cov, hi=0.2)
    return _solved(p, portfolio.mean_variance(problems, risk_aversion=5.0))


@query("h02_minimum_variance")
def _(p: Panels) -> DataFrame:
    return _solved(p, portfolio.minimum_variance(portfolio.problem_rows(*_moments(p))))


@query("h03_maximum_sharpe")
def _(p: Panels) -> DataFrame:
    return _solved(p, portfolio.maximum_sharpe(portfolio.problem_rows(*_moments(p))))


_GRID = [PANEL, "window", "lam"]


def _many_problems(p: Panels) -> tuple[DataFrame, DataFrame]:
    """Moments of every year of weeks, once for each risk aversion, which scales the covariance."""
    rows = positions(p.complete_returns("brand_w")).withColumn("window", F.floor(F.col(POS) / 52))
    years = rows.groupBy(PANEL, "window").agg(F.count_distinct(TS).alias("n")).where("n >= 40").drop("n")
    rows = rows.join(years, [PANEL, "window"])
    lam = F.explode(F.array(F.lit(1.0), F.lit(5.0), F.lit(25.0))).alias("lam")
    mu = market.mean_returns(rows, [PANEL, "window"]).select("*", lam)
    cov = market.covariance(rows, [PANEL, "window"]).select("*", lam)
    return mu, cov.withColumn("cov", F.col("cov") * F.col("lam"))


def _gaps(weights: DataFrame, mu: DataFrame, cov: DataFrame, objective: str) -> DataFrame:
    found = portfolio.optimality_gap(weights, mu, cov, objective, keys=_GRID)
    return found.withColumn("long_only", F.col("least") >= -1e-12).drop("least")


@query("h01_mean_variance_grid")
def _(p: Panels) -> DataFrame:
    mu, cov = _many_problems(p)
    weights = portfolio.mean_variance(portfolio.problem_rows(mu, cov, _GRID), keys=_GRID)
    return _gaps(weights, mu, cov, "mean_variance")


@query("h02_minimum_variance_grid")
def _(p: Panels) -> DataFrame:
    mu, cov = _many_problems(p)
    weights = portfolio.minimum_variance(portfolio.problem_rows(mu, cov, _GRID), keys=_GRID)
    return _gaps(weights, mu.withColumn("mu", F.lit(0.0)), cov, "mean_variance")


@query("h03_maximum_sharpe_grid")
def _(p: Panels) -> DataFrame:
    mu, cov = _many_problems(p)
    weights = portfolio.maximum_sharpe(portfolio.problem_rows(mu, cov, _GRID), keys=_GRID)
    return _gaps(weights, mu, cov, "sharpe")


@query("h04_risk_parity")
def _(p: Panels) -> DataFrame:
    return portfolio.risk_parity(p.brand_covariance, [PANEL])


def _keyed(p: Panels) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Weights, means and covariances with one problem per strategy."""
    weights = _strategies(p).withColumn("problem_id", F.col("strategy"))
    each = weights.select(PANEL, "problem_id").distinct()
    mu = market.mean_returns(p.complete_returns("brand_w")).join(each, PANEL)
    cov = p.brand_covariance.join(each, PANEL)
    return weights.drop(PANEL, "strategy"), mu.drop(PANEL), cov.drop(PANEL)


@query("h05_risk_contributions")
def _(p: Panels) -> DataFrame:
    weights, _mu, cov = _keyed(p)
    return portfolio.risk_contributions(weights, cov)


@query("h06_portfolio_stats")
def _(p: Panels) -> DataFrame:
    return portfolio.portfolio_stats(*_keyed(p))


@query("h07_blend_regime_moments", 7)
def _(p: Panels) -> DataFrame:
    labels = _sign_regimes(p)
    probs = regimes.regime_frequencies(labels).select(PANEL, "regime", "probability")
    mu, cov = market.moments_by_regime(p.complete_returns("brand_w"), labels)
    mu, cov = portfolio.blend_regime_moments(mu, cov, probs)
    return cov.join(mu.withColumnRenamed(SYMBOL, "sym_i"), [PANEL, "sym_i"])


@query("h08_turnover_cost")
def _(p: Panels) -> DataFrame:
    weights = _strategies(p).withColumnRenamed("strategy", "problem_id")
    sizes = weights.groupBy("problem_id").agg(F.count(F.lit(1)).alias("n"))
    now = weights.join(sizes, "problem_id").select("problem_id", SYMBOL, (1 / F.col("n")).alias("weight"))
    return portfolio.turnover_cost(weights.drop(PANEL), now)


@query("h09_regime_aware_portfolio")
def _(p: Panels) -> DataFrame:
    labels = _sign_regimes(p)
    probs = regimes.regime_frequencies(labels).select(PANEL, "regime", "probability")
    current = _strategies(p).where("strategy = 'equal'").drop("strategy")
    weights, stats = portfolio.regime_aware_portfolio(
        p.complete_returns("brand_w"), labels, probs, current
    )
    return weights.join(stats, PANEL)


@query("h10_adaptive_portfolio")
def _(p: Panels) -> DataFrame:
    return portfolio.adaptive_portfolio(
        p.complete_returns("brand_w"), p.volatility_regimes, dates_per_task=16
    )


@query("h10_adaptive_sums")
def _(p: Panels) -> DataFrame:
    """Walk-forward weights per date: how many, their sum, none negative."""
    weights = portfolio.adaptive_portfolio(p.complete_returns("brand_w"), p.volatility_regimes, dates_per_task=16)
    return weights.groupBy(TS).agg(
        F.count("weight").alias("n_assets"), F.sum("weight").alias("total"),
        (F.min("weight") >= -1e-12).alias("long_only"),
    )


# --- backtests ------------------------------------------------------------------------


@query("i01_backtest")
def _(p: Panels) -> DataFrame:
    return p.ledger(_strategies)


@query("i02_constant_weights")
def _(p: Panels) -> DataFrame:
    return backtest.constant_weights(_strategies(p), p.complete_returns("brand_w"))


@query("i03_performance_metrics", 5)
def _(p: Panels) -> DataFrame:
    return backtest.performance_metrics(p.ledger(_strategies))


@query("i04_drawdown_series")
def _(p: Panels) -> DataFrame:
    return backtest.drawdown_series(p.ledger(_strategies)).select("strategy", TS, "wealth", "drawdown")


@query("i05_cumulative_return")
def _(p: Panels) -> DataFrame:
    plain = p.ledger(_strategies).drop("cumulative_return")
    return backtest.cumulative_return(plain).select("strategy", TS, "cumulative_return")


@query("i06_rolling_sharpe", 5)
def _(p: Panels) -> DataFrame:
    return backtest.rolling_sharpe(p.ledger(_strategies))


@query("i07_cumulative_wealth")
def _(p: Panels) -> DataFrame:
    return backtest.cumulative_wealth(p.ledger(_strategies)).drop("portfolio_return")


@query("i08_compare_strategies", 5)
def _(p: Panels) -> DataFrame:
    return backtest.compare_strategies(_strategies(p), p.complete_returns("brand_w"))
