"""Structured Streaming front end: hourly counts of events with late rows, as a file-fed stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, path: str, files_a_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_a_batch).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def hourly_counts(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """(hour, site, n, n_errors): tumbling hours; a row later than ``late`` behind the newest is dropped."""
    return (
        events.withWatermark("ts", late)
        .groupBy(F.window("ts", "1 hour").alias("w"), F.col("user_id").alias("site"))
        .agg(F.count_if(F.col("event_type") != "error").alias("n"), F.count_if(F.col("event_type") == "error").alias("n_errors"))
        .select(F.col("w.start").alias("hour"), "site", "n", "n_errors")
    )


def append_hours(counts: DataFrame, path: str, checkpoint: str):
    """Append closed hours to a Parquet table, exactly once by the sink's log; stops when all files are read."""
    return counts.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
