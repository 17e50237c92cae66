"""Readers of the engine's Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table `name` under `root`: one Parquet file or a folder of parts."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
