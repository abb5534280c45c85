"""Windowed health of a call, source or step log stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_health(trace: DataFrame, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Events, failures and durations per step and tumbling window."""
    return (
        trace.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", window), "step_name")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if(F.col("event_type") == "step_failed").alias("failures"),
            F.sum("duration_ms").alias("duration_ms"),
        )
        .select(F.col("window.start").alias("window_start"), "step_name", "events", "failures", "duration_ms")
    )
