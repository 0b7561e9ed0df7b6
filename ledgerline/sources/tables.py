"""Parquet table access for the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table; Catalyst prunes columns and pushes filters into this scan.

    The session's split size decides the partitions, for small and large inputs alike.
    """
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
