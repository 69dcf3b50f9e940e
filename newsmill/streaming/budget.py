"""The month's budget while costs arrive: two stateful aggregations, one feeding the other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmill.operators.metrics import BUDGET_CAP, alert_level
from newsmill.streaming.alarms import WATERMARK


def budget_stream(metrics: DataFrame, cap: float = BUDGET_CAP, watermark: str = WATERMARK) -> DataFrame:
    """``budget_alerts`` over a stream: a day is emitted once it is final.

    Costs are summed per day; the final days flow on into spans of 31 days that end with
    each day, of which the part in that day's month counts. State is the open days, and 31
    spans of at most two months, whatever the number of metrics; a month leaves it when
    its last span ends. Days without a metric are not emitted.
    """
    days = metrics.withWatermark("ts", watermark).groupBy(F.window("ts", "1 day")).agg(F.sum("cost").alias("cost"))
    days = days.select(F.window_time("window").alias("at"), F.to_date("window.start").alias("day"), "cost")
    spans = days.groupBy(F.window("at", "31 days", "1 day").alias("span"), F.trunc("day", "month").alias("month")).agg(
        F.sum("cost").alias("month_to_date"), F.max("day").alias("day")
    )
    ends = F.to_date(F.col("span.end") - F.expr("interval 1 second"))
    own = spans.filter((F.col("day") == ends) & (F.col("month") == F.trunc(ends, "month")))
    level = alert_level(F.col("month_to_date"), cap)
    return own.select("day", "month_to_date", level.alias("alert_percent")).filter("alert_percent IS NOT NULL")
