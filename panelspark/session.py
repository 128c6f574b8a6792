"""Session helper, the shared folder and tables staged in it."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "panelspark", cores: str | int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the operators expect (UTC, ANSI and AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(folder)
        return folder
    current = spark.sparkContext.getCheckpointDir()
    if current is not None:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="panelspark-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a wide result is needed several times: it is computed once, later plans start
    from a columnar scan that they can prune, and nothing depends on any executor's memory.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stages/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def release(df: DataFrame) -> None:
    """Delete a staged table that no later plan reads; tables outside the shared folder stay."""
    spark = df.sparkSession
    root = urlparse(shared_dir(spark).rstrip("/")).path
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        if urlparse(folder).path.startswith(f"{root}/"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application.

    The grouped kernels import it; executors do not share the driver's import path.
    """
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        here = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="panelspark-code-"), "panelspark")
        archive = shutil.make_archive(target, "zip", os.path.dirname(here), os.path.basename(here))
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(app)
