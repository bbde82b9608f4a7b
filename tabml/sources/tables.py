"""Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Read ``<data_dir>/<name>.parquet``; the schema comes from the file footer,
    and filters/projections applied later push down into the scan."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")
