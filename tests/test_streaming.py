import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from newsmill import schemas
from newsmill.operators import metrics
from newsmill.operators.seen import seen_backfill
from newsmill.streaming import alarms, ingest
from newsmill.streaming.runs import read_batches, write_available, write_batches
from newsmill.streaming.seen import OUTPUT, send_batch

DAY = dt.date(2026, 4, 1)


class Landing:
    """A landing folder, and a stream over it that runs once per landing."""

    def __init__(self, spark, root, schema):
        self.spark, self.root, self.schema = spark, str(root), schema

    def land(self, df):
        df.coalesce(1).write.mode("append").parquet(f"{self.root}/in")

    def source(self):
        return self.spark.readStream.schema(self.schema).parquet(f"{self.root}/in")

    def run(self, transform):
        out = transform(self.source())
        write_available(out, f"{self.root}/out", f"{self.root}/checkpoint")
        return self.spark.read.schema(out.schema).parquet(f"{self.root}/out")

    def run_step(self, step, schema):
        write_batches(self.source(), f"{self.root}/out", f"{self.root}/checkpoint", step, schema)
        return read_batches(self.spark, f"{self.root}/out", schema)


def articles(spark, *rows):
    df = spark.createDataFrame(list(rows), "id string, published string, scraped string, source_ord int, pos bigint")
    return df.selectExpr(
        "id", "'T' title", "'u' url", "'s' source", "'rss' source_type", "'c' content", "cast(published as timestamp) published_at",
        "cast(scraped as timestamp) scraped_at", "source_ord", "pos",
    )


def test_first_arrivals_lose_nothing(spark, tmp_path):
    landing = Landing(spark, tmp_path, schemas.ARTICLE)
    day = "2026-04-01 00:00:00"
    landing.land(articles(spark, *[("hot", day, day, 0, p) for p in range(500, 0, -1)], ("ahead", "2099-01-01 00:00:00", day, 1, 0)))
    first = landing.run_step(ingest.first_arrivals, schemas.ARTICLE)
    assert sorted((r.id, r.pos) for r in first.collect()) == [("ahead", 0), ("hot", 1)]
    later = "2026-04-20 00:00:00"
    landing.land(articles(spark, ("hot", later, later, 0, 7), ("old", "2001-01-01 00:00:00", later, 0, 8), ("new", later, later, 0, 9)))
    second = landing.run_step(ingest.first_arrivals, schemas.ARTICLE)
    assert sorted(r.id for r in second.collect()) == ["ahead", "hot", "new", "old"]


def test_first_arrivals_within_days(spark):
    earlier = articles(spark, ("a", "2026-04-01 00:00:00", "2026-04-01 00:00:00", 0, 1))
    batch = articles(spark, *[("a", f"2026-04-{d} 00:00:00", f"2026-04-{d} 00:00:00", 0, d) for d in (9,)])
    assert ingest.first_arrivals(batch, earlier, days=7).count() == 1
    assert ingest.first_arrivals(batch, earlier, days=8).count() == 0
    assert ingest.first_arrivals(batch, earlier).count() == 0


def test_a_batch_that_runs_again_replaces_its_result(spark, tmp_path):
    landing = Landing(spark, tmp_path, "id string, run_date date")
    landing.land(spark.createDataFrame([("a", DAY)], "id string, run_date date"))
    landing.run_step(send_batch, OUTPUT)
    again = send_batch(spark.createDataFrame([("a", DAY)], "id string, run_date date"), spark.createDataFrame([], OUTPUT))
    again.write.mode("overwrite").parquet(f"{tmp_path}/out/batch_id=0")
    assert read_batches(spark, f"{tmp_path}/out", OUTPUT).count() == 1


def test_late_days_are_listed(spark):
    earlier = spark.createDataFrame([("a", DAY + dt.timedelta(days=3), False)], OUTPUT)
    days = [("a", DAY), ("a", DAY + dt.timedelta(days=3)), ("a", DAY + dt.timedelta(days=11)), ("b", DAY)]
    rows = send_batch(spark.createDataFrame(days, "id string, run_date date"), earlier).collect()
    assert {tuple(r) for r in rows} == {("a", DAY, True), ("a", DAY + dt.timedelta(days=11), False), ("b", DAY, False)}
    assert send_batch(spark.createDataFrame([], "id string, run_date date"), earlier).count() == 0


@pytest.mark.parametrize("files", [1, 3])
def test_send_stream_equals_the_backfill(spark, tmp_path, files):
    rng = random.Random(files)
    rows = sorted({(f"id{rng.randrange(25)}", DAY + dt.timedelta(days=rng.randrange(40))) for _ in range(400)},
                  key=lambda r: r[1])
    landing = Landing(spark, tmp_path, "id string, run_date date")
    size = -(-len(rows) // files)
    for start in range(0, len(rows), size):
        part = rows[start : start + size]
        landing.land(spark.createDataFrame(part + part[:20], "id string, run_date date"))
        sent = landing.run_step(send_batch, OUTPUT)
    df = spark.createDataFrame(rows, "id string, run_date date").withColumn("included", F.lit(True))
    expected = {(r.id, r.sent_date) for r in seen_backfill(df).collect()}
    found = [(r.id, r.sent_date) for r in sent.collect()]
    assert set(found) == expected and len(found) == len(expected)


METRIC = """ts timestamp, fn string, status string, is_error boolean, duration double, sends int, bounces int,
            cost decimal(18,6)"""


def test_alarm_stream_drops_late_rows(spark, tmp_path):
    landing = Landing(spark, tmp_path, METRIC)

    def land(*rows):
        df = spark.createDataFrame([(f"2026-04-18 {t}", fn, e) for t, fn, e in rows], "t string, fn string, e boolean")
        landing.land(df.select(F.col("t").cast("timestamp").alias("ts"), "fn", F.lit("failed").alias("status"),
                               F.col("e").alias("is_error"), F.lit(1.0).alias("duration"), F.lit(0).alias("sends"),
                               F.lit(0).alias("bounces"), F.lit(0).cast("decimal(18,6)").alias("cost")))

    def found(df):
        rows = df.filter("alarm <> 'run-failures'").collect()
        return sorted((r.window_start.strftime("%H:%M"), r.alarm, r.n) for r in rows)

    land(("06:00:00", "Filter", True), ("06:01:00", "Filter", True), ("06:06:00", "Filter", True))
    assert found(landing.run(alarms.error_alarm_stream)) == []
    land(("06:30:00", "Filter", False))
    assert found(landing.run(alarms.error_alarm_stream)) == [("06:00", "filter-errors", 2), ("06:05", "filter-errors", 1)]
    land(("06:02:00", "Filter", True), ("06:22:00", "Notifier", True), ("07:00:00", "Filter", False))
    final = landing.run(alarms.error_alarm_stream)
    assert found(final) == [("06:00", "filter-errors", 2), ("06:05", "filter-errors", 1), ("06:20", "notifier-errors", 1)]
    # The batch operator over the same rows also counts the late one.
    batch = metrics.error_alarms(spark.read.schema(METRIC).parquet(f"{tmp_path}/in")).filter("alarm = 'filter-errors'")
    assert sorted(r.n for r in batch.collect()) == [1, 3]


def test_p95_stream_is_close_to_the_exact_value(spark, tmp_path):
    landing = Landing(spark, tmp_path, METRIC)
    df = spark.range(2000).select(
        F.timestamp_seconds(F.lit(1776492000) + F.col("id") * 3).alias("ts"), F.lit("Filter").alias("fn"),
        F.lit("succeeded").alias("status"), F.lit(False).alias("is_error"),
        F.rand(1).alias("duration"), F.lit(0).alias("sends"), F.lit(0).alias("bounces"),
        F.lit(0).cast("decimal(18,6)").alias("cost"),
    )
    landing.land(df)
    found = {r.window_start: r.p95 for r in landing.run(alarms.hourly_p95_stream).collect()}
    exact = {r.window_start: r.p95 for r in metrics.hourly_p95(spark.read.parquet(f"{tmp_path}/in")).collect()}
    assert found
    for start, value in found.items():
        assert value == pytest.approx(exact[start], abs=0.01)
