import datetime as dt

from pyspark.sql import functions as F

from newsmill.functions import dates

FALLBACK = dt.datetime(2026, 4, 19, 6)


def parse(spark, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    out = dates.parse_lenient(F.col("v"), F.lit("2026-04-19 06:00:00").cast("timestamp"))
    return [r.o for r in rows.select("i", out.cast("timestamp_ntz").alias("o")).orderBy("i").collect()]


def test_lenient_dates(spark):
    cases = {
        "Fri, 18 Apr 2026 08:00:00 +0000": dt.datetime(2026, 4, 18, 8),
        "Sat, 18 Apr 2026 08:00:00 GMT": dt.datetime(2026, 4, 18, 8),
        "Sat, 18 Apr 2026 08:00:00 UT": dt.datetime(2026, 4, 18, 8),
        "18 Apr 2026 08:00:00 +0200": dt.datetime(2026, 4, 18, 6),
        "Sat, 18 Apr 2026 08:00:00 EST": dt.datetime(2026, 4, 18, 13),
        "18 Apr 2026 08:30 GMT": dt.datetime(2026, 4, 18, 8, 30),
        "18 Apr 26 08:00:00 GMT": dt.datetime(2026, 4, 18, 8),
        "2026-04-18T09:00:00Z": dt.datetime(2026, 4, 18, 9),
        "2026-04-18T09:00:00.250+01:00": dt.datetime(2026, 4, 18, 8, 0, 0, 250000),
        "2026-04-18": dt.datetime(2026, 4, 18),
        "April 18, 2026": dt.datetime(2026, 4, 18),
        "Apr 18, 2026 07:00:00": dt.datetime(2026, 4, 18, 7),
        "18 Apr 2026": dt.datetime(2026, 4, 18),
        "2026/04/18 05:00:00": dt.datetime(2026, 4, 18, 5),
        "": FALLBACK,
        None: FALLBACK,
        "soon": FALLBACK,
        "12:30": FALLBACK,
        "now": FALLBACK,
    }
    assert parse(spark, cases) == list(cases.values())


def test_display_date(spark):
    rows = spark.createDataFrame([("2026-04-08T09:00:00Z",), ("not a date",)], "v string")
    assert [r.o for r in rows.select(dates.display_date(F.col("v")).alias("o")).collect()] == ["Apr 8, 2026", "not a date"]


def test_run_date_and_iso(spark):
    rows = spark.createDataFrame([("2026-04-18",), ("2026-04-18T23:59:59.999Z",)], "v string")
    assert {r.o for r in rows.select(dates.run_date(F.col("v")).alias("o")).collect()} == {dt.date(2026, 4, 18)}
    one = spark.sql("select timestamp '2026-04-18 01:02:03.004' t")
    assert one.select(dates.iso_millis(F.col("t")).alias("o")).first().o == "2026-04-18T01:02:03.004Z"


def test_recent_includes_the_bound(spark):
    rows = spark.createDataFrame([("2026-04-17 06:00:00",), ("2026-04-17 05:59:59.999",)], "t string")
    rows = rows.select(F.col("t").cast("timestamp").alias("t"))
    assert rows.filter(dates.recent(F.col("t"), "2026-04-19 06:00:00")).count() == 1
    assert rows.filter(dates.recent(F.col("t"), "2026-04-19 06:00:00", 49)).count() == 2
