"""Interval merging over an event stream: an extension of the batch operator to Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_stream(events: DataFrame, keys: list[str], ts: str, gap: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Runs of events of a key no more than ``gap`` apart: (keys, start, end, n), out once the watermark passes them.

    Works on batch and streaming input; state is bounded by the sessions open within ``late``.
    """
    timed = events.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", late)
    return timed.groupBy(*keys, F.session_window("__ts", gap).alias("w")).agg(F.count("*").alias("n")).select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def window_counts(events: DataFrame, keys: list[str], ts: str, width: str = "5 minutes", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    timed = events.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", late)
    return timed.groupBy(*keys, F.window("__ts", width, slide or width).alias("w")).agg(F.count("*").alias("n")).select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
