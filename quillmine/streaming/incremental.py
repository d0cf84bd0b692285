"""Resumable incremental runs as a stream over files: what has been read is not read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def process_new(spark: SparkSession, source: str, schema, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], partition_by: list[str] | None = None, files_per_batch: int = 1000) -> None:
    """Files that came since the last call go through transform and are added to target, each exactly once (the sink's
    log and the checkpoint make a rerun after a failure safe)."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    out = transform(rows).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    (out.partitionBy(*partition_by) if partition_by else out).start().awaitTermination()


def windowed_counts(events: DataFrame, time: str, window: str, late: str, by: list[str]) -> DataFrame:
    """Counts in tumbling windows; events later than `late` behind the newest are left out. Works on tables and streams."""
    return events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), *by, "n")
