import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from newsmill import schemas
from newsmill.operators import metrics
from newsmill.streaming import budget, ingest, late, replies
from newsmill.streaming.memory import Memory
from newsmill.streaming.runs import read_batches, write_available, write_batches
from newsmill.streaming.seen import OUTPUT, send_batch, send_dates, send_remembered

DAY = dt.date(2025, 3, 1)


def appearances(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, run_date date")


class Landing:
    def __init__(self, spark, root, schema):
        self.spark, self.root, self.schema = spark, str(root), schema

    def run(self, df, step, out, memory=None, remember=None):
        df.coalesce(1).write.mode("append").parquet(f"{self.root}/in")
        stream = self.spark.readStream.schema(self.schema).parquet(f"{self.root}/in")
        write_batches(stream, f"{self.root}/out", f"{self.root}/checkpoint", step, out, memory, remember)
        return read_batches(self.spark, f"{self.root}/out", out)


def test_rows_read_per_batch_do_not_grow(spark, tmp_path):
    """Twelve landings of ten new ids each: what a batch reads of its memory stays within the days kept."""
    landing = Landing(spark, tmp_path, "id string, run_date date")
    memory, read = Memory(f"{tmp_path}/memory", "date", keep_days=3, every=2), []

    def step(batch, known):
        read.append(known.count())
        return send_remembered(batch, known, keep_days=3, lookback=2)

    for n in range(12):
        rows = [(f"{n}-{i}", DAY + dt.timedelta(n)) for i in range(10)]
        found = landing.run(appearances(spark, *rows), step, OUTPUT, memory, send_dates)
    assert found.filter("not late").count() == 120
    # The days kept, the day of the fold, and a batch since: never more, whatever came before.
    assert max(read) <= 50 and read[4:] == read[4:6] * 4


def test_memory_equals_whole_history(spark, tmp_path):
    """In-order days in random landings: the same sends as with everything read."""
    rng = random.Random(7)
    rows = sorted({(f"a{rng.randrange(25)}", DAY + dt.timedelta(rng.randrange(40))) for _ in range(300)}, key=lambda r: r[1])
    cuts = [0, 40, 90, 91, 160, 230, len(rows)]
    schema = "id string, run_date date"
    whole, kept = (Landing(spark, tmp_path / name, schema) for name in ("whole", "kept"))
    memory = Memory(f"{tmp_path}/memory", "date", keep_days=7, every=2)
    for a, b in zip(cuts, cuts[1:], strict=False):
        part = appearances(spark, *[r for r in rows if rows[a][1] <= r[1] and (b == len(rows) or r[1] < rows[b][1])])
        one = whole.run(part, send_batch, OUTPUT)
        two = kept.run(part, lambda batch, known: send_remembered(batch, known, 7), OUTPUT, memory, send_dates)
    expected = {(r.id, r.sent_date, r.late) for r in one.collect()}
    assert {(r.id, r.sent_date, r.late) for r in two.collect()} == expected and len(expected) > 50


def test_days_past_memory_are_late(spark, tmp_path):
    landing = Landing(spark, tmp_path, "id string, run_date date")
    memory = Memory(f"{tmp_path}/memory", "date", keep_days=7, every=1)

    def step(batch, known):
        return send_remembered(batch, known, 7)

    landing.run(appearances(spark, ("a", DAY), ("b", DAY + dt.timedelta(30))), step, OUTPUT, memory, send_dates)
    old = DAY + dt.timedelta(1)
    found = landing.run(appearances(spark, ("new", old), ("b", DAY + dt.timedelta(31)), (None, old)), step, OUTPUT, memory, send_dates)
    late = {r.id for r in found.filter("late").collect()}
    assert late == {"new", None}
    assert found.filter("id = 'b' and not late").count() == 1
    with pytest.raises(ValueError):
        send_remembered(appearances(spark), memory.read(spark, 2), 3)


def test_a_batch_that_runs_again_reads_the_same(spark, tmp_path):
    memory = Memory(f"{tmp_path}/memory", "date", every=2)
    rows = spark.createDataFrame([("a", DAY)], "id string, at date")
    assert memory.read(spark, 0).count() == 0
    for number in (0, 1, 1, 2, 2):
        memory.write(rows.withColumn("at", F.date_add("at", number)), number)
    assert [r.at for r in memory.read(spark, 2).collect()] == [DAY + dt.timedelta(1)]
    assert sorted(r.at for r in memory.read(spark, 3).collect()) == [DAY + dt.timedelta(1), DAY + dt.timedelta(2)]
    memory.write(rows.limit(0), 3)
    assert [r.at for r in memory.read(spark, 4).collect()] == [DAY + dt.timedelta(2)]
    plan = memory.read(spark, 4).filter(F.col("day") >= F.lit(DAY))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_remembered_arrivals(spark, tmp_path):
    def article(key, day, pos):
        return (key, "T", "u", "s", "rss", "c", dt.datetime(2025, 3, day), dt.datetime(2025, 3, day, 12), 0, pos)

    landing = Landing(spark, tmp_path, schemas.ARTICLE)
    memory = Memory(f"{tmp_path}/memory", keep_days=2, every=1)
    for rows in ([article("a", 1, 1), article("a", 1, 0)], [article("a", 3, 2), article("b", 3, 3)], [article("a", 9, 4), article("b", 5, 5)]):
        df = spark.createDataFrame(rows, schemas.ARTICLE)
        found = landing.run(df, lambda b, k: ingest.remembered_arrivals(b, k, 2), schemas.ARTICLE, memory, ingest.arrival_times)
    assert sorted((r.id, r.pos) for r in found.collect()) == [("a", 0), ("a", 4), ("b", 3)]


class TestReplies:
    ASKED, ANSWERED = "id string, content string, arrived_at timestamp", "id string, response_text string, replied_at timestamp"

    def land(self, spark, root, asked, answered):
        spark.createDataFrame(asked, self.ASKED).coalesce(1).write.mode("append").parquet(f"{root}/asked")
        spark.createDataFrame(answered, self.ANSWERED).coalesce(1).write.mode("append").parquet(f"{root}/answered")
        waited = replies.await_replies(
            spark.readStream.schema(self.ASKED).parquet(f"{root}/asked"), spark.readStream.schema(self.ANSWERED).parquet(f"{root}/answered"), "2 hours", "0 seconds"
        )
        write_available(waited, f"{root}/out", f"{root}/checkpoint")
        return spark.read.schema(waited.schema).parquet(f"{root}/out")

    def test_late_and_missing_replies(self, spark, tmp_path):
        def at(hour, minute=0):
            return dt.datetime(2025, 3, 1, hour, minute)

        asked = [(k, f"text of {k}", at(1)) for k in ("soon", "later", "never", "twice")]
        out = self.land(spark, tmp_path, asked, [("soon", '{"summary": "s"}', at(1, 5)), ("twice", "b", at(2)), ("stranger", "x", at(1))])
        assert {r.id for r in out.collect()} == {"soon", "twice"}
        # The reply to "later" comes in another run; the second one to "twice" does not count, nor does one after the limit.
        second = [("later", '{"summary": "l"}', at(3)), ("twice", '{"summary": "too late to count"}', at(2, 30)), ("never", "{}", at(3, 1)), ("beat", "", at(9))]
        out = self.land(spark, tmp_path, [("beat", "", at(9))], second)
        done = replies.triaged(out.filter("id <> 'beat'"))
        found = {r.id: (r.triage_status, r.summary) for r in done.collect()}
        assert found == {"soon": ("parsed", "s"), "later": ("parsed", "l"), "twice": ("fallback", "text of twice"), "never": ("missing", None)}
        assert [r.id for r in replies.quarantine(done).collect()] == ["never"]


def test_budget_stream_across_months(spark, tmp_path):
    start = dt.datetime(2025, 1, 20, 3)
    rows = [(start + dt.timedelta(hours=7 * i), 1.5) for i in range(0, 260)]
    rows = [r for r in rows if r[0].day != 7]  # a day without costs is not emitted
    df = spark.createDataFrame(rows, "ts timestamp, c double").select("ts", F.col("c").cast("decimal(18,6)").alias("cost"))
    parts = [df.filter(F.col("ts") < "2025-02-10"), df.filter(F.col("ts") >= "2025-02-10")]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = budget.budget_stream(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"))
        write_available(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    found = {(r.day, float(r.month_to_date), r.alert_percent) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    last = max(r[0] for r in rows) - dt.timedelta(minutes=10)
    expected = {
        (r.day, float(r.month_to_date), r.alert_percent)
        for r in metrics.budget_alerts(df).collect()
        if dt.datetime.combine(r.day, dt.time()) + dt.timedelta(1) <= last
    }
    assert found == expected and len({d.month for d, *_ in found}) >= 2


def test_late_signals_are_listed_and_nothing_is_lost(spark, tmp_path):
    """Random landings: alarms of closed windows and listed signals add up to the counts of the batch form."""
    rng = random.Random(4)
    start = dt.datetime(2025, 3, 1)
    schema = "ts timestamp, fn string, status string, is_error boolean"
    rows = [(start + dt.timedelta(minutes=rng.randrange(90)), "Filter", rng.choice(["failed", "timed_out", None]), rng.random() < 0.4) for _ in range(200)]
    root, read = str(tmp_path), []
    for n in range(4):
        spark.createDataFrame(rows[n * 50 : n * 50 + 50], schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        late.write_alarms(spark.readStream.schema(schema).parquet(f"{root}/in"), root, f"{root}/checkpoint")
        read.append(late.read_late(spark, root).count())
    closed = max(r[0] for r in rows) - late.DELAY
    expected = {}
    for r in metrics.error_alarms(spark.createDataFrame(rows, schema)).collect():
        if r.window_start + dt.timedelta(minutes=5) <= closed:
            expected[r.window_start, r.alarm] = r.n
    found = {(r.window_start, r.alarm): r.n for r in late.read_alarms(spark, root).collect()}
    assert read[0] == 0 < read[1] < read[-1]
    for r in late.read_late(spark, root).collect():
        assert r.window_start <= r.ts < r.window_start + dt.timedelta(minutes=5)
        found[r.window_start, r.alarm] = found.get((r.window_start, r.alarm), 0) + 1
    assert found == expected


def test_late_batch_that_runs_again_replaces_its_counts(spark, tmp_path):
    root = str(tmp_path)
    schema = "ts timestamp, fn string, status string, is_error boolean"
    for minute in (0, 40):
        row = (dt.datetime(2025, 3, 1, 0, minute), "Filter", "failed", False)
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        for checkpoint in (("a",) if minute else ("lost", "a")):
            late.write_alarms(spark.readStream.schema(schema).parquet(f"{root}/in"), root, f"{root}/{checkpoint}")
    assert [(r.alarm, r.n) for r in late.read_alarms(spark, root).collect()] == [("run-failures", 1)]
    assert late.read_late(spark, root).count() == 0
