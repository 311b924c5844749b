"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset a local session gets a folder of its own, as in tests; on a cluster that would be a folder of one machine, so it is an error there."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='textloom-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def small_side(df: DataFrame, row_bytes: int, most_bytes: int = 32 << 20) -> DataFrame:
    """``df`` marked for broadcast if its rows are counted to fit in ``most_bytes``, else as it is, for a shuffled join."""
    return F.broadcast(df) if df.count() * row_bytes <= most_bytes else df


def written(df: DataFrame, name: str, **options: object) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back, which cuts lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gathered(parts: Iterable[DataFrame], name: str, spark: SparkSession, schema: str) -> DataFrame:
    """``written`` of all rows of ``parts``, each of which is written before the next is asked for."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    spark.createDataFrame([], schema).write.parquet(path)
    for df in parts:
        df.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)
