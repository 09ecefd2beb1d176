"""Scan a table by name.  Only the columns a plan uses are read:
Catalyst prunes the parquet ReadSchema and pushes filters into the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``base`` is a folder of ``<name>.parquet`` files (or directories)."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")

