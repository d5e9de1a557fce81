"""Event counts over a stream of the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_counts(events: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """(day, event_type, n): a count per day and type, final once the watermark has passed the day's end."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    counts = timed.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("w.start").alias("day"), "event_type", "n")
