"""Monitoring aggregates and alarms over a metric table.

Columns: ts, fn, status (succeeded, failed, timed_out or NULL), is_error,
duration, sends, bounces, cost. Every aggregate is partial before its shuffle,
and a window without rows gives no row (missing data does not breach).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmill.operators.quantile import exact_quantile

STATUSES = ("succeeded", "failed", "timed_out")

# Alarm thresholds.
ERROR_THRESHOLD = 1
BOUNCE_RATE_THRESHOLD = 0.05
BUDGET_CAP = 20
BUDGET_PERCENTS = (80, 100)


def _start(period: str) -> Column:
    return F.window("ts", period)["start"]


def hour_start() -> Column:
    return _start("1 hour")


def signals() -> Column:
    """The alarms that a metric counts for: an error of its function, a failure, a timeout."""
    each = F.array(
        F.when(F.col("is_error"), F.concat(F.lower("fn"), F.lit("-errors"))),
        F.when(F.col("status") == "failed", F.lit("run-failures")),
        F.when(F.col("status") == "timed_out", F.lit("run-timeouts")),
    )
    return F.array_compact(each)


def error_alarms(metrics: DataFrame) -> DataFrame:
    """Five-minute windows with an error of a function, a failure or a timeout."""
    counted = metrics.select("ts", F.explode(signals()).alias("alarm"))
    counts = counted.groupBy(_start("5 minutes").alias("window_start"), "alarm").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= ERROR_THRESHOLD)


def hourly_status(metrics: DataFrame) -> DataFrame:
    """Runs per hour and status, one column per status."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    return metrics.groupBy(_start("1 hour").alias("window_start")).agg(*counts)


def hourly_errors(metrics: DataFrame) -> DataFrame:
    """Errors per hour and function."""
    return metrics.groupBy(_start("1 hour").alias("window_start"), "fn").agg(F.count_if("is_error").alias("errors"))


def hourly_p95(metrics: DataFrame) -> DataFrame:
    """Exact 95th percentile of the duration per hour and function."""
    hourly = metrics.select(_start("1 hour").alias("window_start"), "fn", "duration")
    return exact_quantile(hourly, ["window_start", "fn"], "duration", 0.95, "p95")


def rate_alarm(metrics: DataFrame) -> DataFrame:
    """Hours whose bounce rate reaches the threshold."""
    hourly = metrics.groupBy(_start("1 hour").alias("window_start")).agg(
        F.sum("sends").alias("sends"), F.sum("bounces").alias("bounces")
    )
    tried = F.col("sends") + F.col("bounces")
    rate = F.when(tried > 0, F.col("bounces") / tried)
    return hourly.withColumn("bounce_rate", rate).filter(F.col("bounce_rate") >= BOUNCE_RATE_THRESHOLD)


def daily_sends(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy(_start("24 hours").alias("window_start")).agg(
        F.sum("sends").alias("sends"), F.sum("bounces").alias("bounces")
    )


def alert_level(spent: Column, cap: float = BUDGET_CAP) -> Column:
    """The highest share of the cap, in per cent, that ``spent`` is above; NULL below the lowest."""
    percent = spent * 100 / F.lit(cap).cast("decimal(18,2)")
    crossed = F.lit(None).cast("int")
    for level in BUDGET_PERCENTS:
        crossed = F.when(percent > level, level).otherwise(crossed)
    return crossed


def budget_alerts(metrics: DataFrame, cap: float = BUDGET_CAP) -> DataFrame:
    """Days on which the month's cost so far is above a share of the cap.

    The running sum is over days, at most 31 per month. ``cost`` is decimal,
    so sums do not depend on the order in which partitions are merged.
    """
    days = metrics.groupBy(F.to_date("ts").alias("day")).agg(F.sum("cost").alias("cost"))
    month = Window.partitionBy(F.trunc("day", "month")).orderBy("day")
    spent = days.withColumn(
        "month_to_date", F.sum("cost").over(month.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    return spent.withColumn("alert_percent", alert_level(F.col("month_to_date"), cap)).filter("alert_percent IS NOT NULL")
