"""Reading the Parquet tables of one scale directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read ``{sf_dir}/{name}.parquet`` through Spark's own reader, so that any file system it knows will do."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
