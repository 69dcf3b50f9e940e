"""Streaming alarms and percentiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmill.operators.metrics import ERROR_THRESHOLD, signals

#: How late a metric may come, unless said otherwise; later ones are not counted.
WATERMARK = "10 minutes"


def error_alarm_stream(metrics: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """``error_alarms`` over a stream: windows are emitted once they are final.

    Every row advances the watermark, whether it counts for an alarm or not.
    """
    return (
        metrics.withWatermark("ts", watermark)
        .select("ts", F.explode(signals()).alias("alarm"))
        .groupBy(F.window("ts", "5 minutes"), "alarm")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= ERROR_THRESHOLD)
        .select(F.col("window.start").alias("window_start"), "alarm", "n")
    )


def hourly_p95_stream(metrics: DataFrame, accuracy: int = 10_000, watermark: str = WATERMARK) -> DataFrame:
    """95th percentile per hour and function, in fixed-size state.

    The value is one of the durations; it is exact while an hour of a function
    has fewer than ``accuracy`` of them, and within one part in ``accuracy`` of
    the rank beyond that.
    """
    return (
        metrics.withWatermark("ts", watermark)
        .groupBy(F.window("ts", "1 hour"), "fn")
        .agg(F.percentile_approx("duration", 0.95, accuracy).alias("p95"))
        .select(F.col("window.start").alias("window_start"), "fn", "p95")
    )
