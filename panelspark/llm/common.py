"""What the corpus operators share: reading tables, staged copies, unions of links."""

from __future__ import annotations

import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.session import release, shared_dir, ship_package


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of one table; an absent column becomes NULL text."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    ship_package(spark)
    return df.select(*columns) if columns else df


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores before it until no column has it."""
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one, as a URI Spark can write to."""
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def mounted(uri: str) -> str:
    """The path under which tasks open files of a folder that every machine mounts.

    Flat binary files and archives are opened by the tasks themselves, so the shared folder has to
    be a mounted one (NFS, Lustre, a FUSE mount of an object store); another scheme is refused.
    """
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"binary files need a mounted shared folder, not {parts.scheme}://")
    return unquote(parts.path)


def stage(df: DataFrame, purpose: str = "stage") -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, survives lost executors."""
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return row[0], row[1]


def components(links: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b: long); component is the smallest node reached.

    Alternating large-star and small-star rounds: every node learns the least neighbour with a
    pre-aggregated minimum, so a hub with many neighbours costs one row per task in the exchange; the
    joins that follow have a row per link and can be split by adaptive execution. Each round is a
    staged table. Raises if ``rounds`` don't suffice (each round at least halves a chain of hubs).
    """
    edges = stage(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    seen = _digest(edges)
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = (
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            joined.select("a", F.col("m").alias("b"))
        )
        new = stage(small.where("a <> b").distinct(), "links")
        now = _digest(new)
        release(edges)
        edges = new
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    # settled: every edge is (node, root)
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
