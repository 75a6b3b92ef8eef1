"""Table scans. Column pruning and filters are left to Catalyst: every reader is a plain lazy scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``sf_dir`` (one file or a folder of parts)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
