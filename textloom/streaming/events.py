"""Structured Streaming over an event table: windowed counts, idempotent append, stream-static join and keyed state.

Each stream reads files as they come and can run to the end of what is there (``availableNow``); its batch twin gives the
same rows, which tests hold it to.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.sources.shared import shared_dir


def stream(spark: SparkSession, sf_dir: str, name: str = "events") -> DataFrame:
    """The table's files as a stream; ``ts`` becomes a timestamp, as watermarks need it."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    # A single file is a stream of one file: its folder, filtered by name.
    folder, _, file = path.rpartition("/")
    return spark.readStream.schema(schema).option("pathGlobFilter", file).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def window_counts(events: DataFrame, size: str = "1 day", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """(start, event_type, n, total) by tumbling, or with ``slide`` hopping, event-time windows."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    counted = events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return counted.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", "total")


def session_counts(events: DataFrame, gap: str = "6 hours", late: str = "10 minutes") -> DataFrame:
    """(user_id, start, n) by session windows."""
    counted = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("start"), "n")


def once(events: DataFrame, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """Idempotent append: the first event of each key within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def finished(df: DataFrame, mode: str = "complete") -> DataFrame:
    """Run a stream over all there is and return the result table."""
    folder = f"{shared_dir(df.sparkSession)}/stream-{uuid.uuid4().hex}"

    def write(batch: DataFrame, number: int) -> None:
        # A batch that is run again replaces what it wrote; complete results replace the former ones.
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number if mode == 'append' else 0}")

    run = df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/out").select(*df.columns)


def both(build: Callable[[DataFrame], DataFrame], spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(streamed, batch) results of the same transformation."""
    batch = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    return finished(build(stream(spark, sf_dir))), build(batch)
