import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsmill.operators import metrics


def table(spark, *rows):
    schema = "t string, fn string, status string, is_error boolean, duration double, sends int, bounces int, cost string"
    df = spark.createDataFrame(list(rows), schema)
    return df.select(F.col("t").cast("timestamp").alias("ts"), "fn", "status", "is_error", "duration", "sends", "bounces",
                     F.col("cost").cast("decimal(18,6)").alias("cost"))


def row(t, fn="Filter", status=None, is_error=False, duration=1.0, sends=0, bounces=0, cost="0"):
    return (f"2026-04-{t}", fn, status, is_error, duration, sends, bounces, cost)


def test_error_alarms(spark):
    df = table(
        spark,
        row("18 06:00:00", is_error=True, status="failed"),
        row("18 06:04:59", is_error=True),
        row("18 06:05:00", fn="Notifier", is_error=True),
        row("18 06:05:00", status="timed_out"),
        row("18 06:10:00", status="succeeded"),
    )
    found = {(r.window_start.strftime("%H:%M"), r.alarm): r.n for r in metrics.error_alarms(df).collect()}
    assert found == {
        ("06:00", "filter-errors"): 2,
        ("06:00", "run-failures"): 1,
        ("06:05", "notifier-errors"): 1,
        ("06:05", "run-timeouts"): 1,
    }


def test_hourly(spark):
    df = table(
        spark,
        row("18 06:00:00", status="succeeded", duration=1.0),
        row("18 06:59:00", status="succeeded", duration=2.0, is_error=True),
        row("18 07:00:00", status="failed", duration=9.0),
    )
    status = {r.window_start.hour: (r.succeeded, r.failed, r.timed_out) for r in metrics.hourly_status(df).collect()}
    assert status == {6: (2, 0, 0), 7: (0, 1, 0)}
    assert {r.window_start.hour: r.errors for r in metrics.hourly_errors(df).collect()} == {6: 1, 7: 0}
    assert {r.window_start.hour: r.p95 for r in metrics.hourly_p95(df).collect()} == pytest.approx({6: 1.95, 7: 9.0})


def test_rate_alarm_includes_the_threshold(spark):
    df = table(
        spark,
        row("18 06:00:00", sends=19, bounces=1),
        row("18 07:00:00", sends=20, bounces=1),
        row("18 08:00:00"),
        row("18 09:00:00", bounces=3),
    )
    assert {r.window_start.hour: r.bounce_rate for r in metrics.rate_alarm(df).collect()} == {6: 0.05, 9: 1.0}


def test_daily_sends(spark):
    df = table(spark, row("18 00:00:00", sends=2), row("18 23:59:59", sends=1, bounces=1), row("19 00:00:00", sends=5))
    found = {r.window_start.day: (r.sends, r.bounces) for r in metrics.daily_sends(df).collect()}
    assert found == {18: (3, 1), 19: (5, 0)}


def test_budget(spark):
    df = table(
        spark,
        row("01 00:00:00", cost="16"),
        row("02 00:00:00", cost="0.000001"),
        row("03 00:00:00", cost="3.999999"),
        row("04 00:00:00", cost="0.5"),
    )
    df = df.union(df.filter("day(ts) = 1").withColumn("ts", F.col("ts") + F.expr("interval 30 days")))
    found = {r.day: r.alert_percent for r in metrics.budget_alerts(df).collect()}
    assert found == {dt.date(2026, 4, 2): 80, dt.date(2026, 4, 3): 80, dt.date(2026, 4, 4): 100}
    assert metrics.budget_alerts(df, cap=100).count() == 0
