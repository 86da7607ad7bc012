"""Reader for the input tables (one parquet file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazily scan one table.  Column pruning and filter pushdown are left to
    Catalyst: callers select only what they use, so the parquet scan's
    ReadSchema stays narrow."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
