"""Sinks for features, regimes, weights and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelspark.schema import PANEL

FORMATS = {"parquet": "parquet", "csv": "csv", "feather": "parquet"}


def write_features(df: DataFrame, path: str, format: str = "parquet", mode: str = "overwrite") -> None:
    """Write by panel. Feather has no distributed writer and is stored as Parquet."""
    if format not in FORMATS:
        raise ValueError(f"Unsupported format: {format}")
    writer = df.write.mode(mode)
    if PANEL in df.columns:
        writer = writer.partitionBy(PANEL)
    if FORMATS[format] == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def write_results(folder: str, mode: str = "overwrite", **tables: DataFrame) -> dict[str, str]:
    """Regimes as Parquet, the smaller result tables as CSV; returns where each went."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder}/{name}"
        if name.startswith("regimes"):
            df.write.mode(mode).parquet(paths[name])
        else:
            df.write.mode(mode).option("header", True).csv(paths[name])
    return paths
