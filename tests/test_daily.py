import datetime as dt
import json

from pyspark.sql import functions as F

from newsmill.functions.text import article_id
from newsmill.operators import policy, seen
from newsmill.plans import daily
from newsmill.sources import tables

GENERATED = "2026-04-18 06:30:00"


def source(spark, *names, kind="rss"):
    rows = [(n, i) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "title string, pos bigint").select(
        article_id(F.concat(F.lit("https://e.com/"), "title")).alias("id"),
        "title",
        F.concat(F.lit("https://e.com/"), "title").alias("url"),
        F.lit("Feed").alias("source"),
        F.lit(kind).alias("source_type"),
        F.concat(F.lit("Content of "), "title").alias("content"),
        F.lit("2026-04-18 05:00:00").cast("timestamp").alias("published_at"),
        F.lit("2026-04-18 06:00:00").cast("timestamp").alias("scraped_at"),
        F.lit(0).alias("source_ord"),
        "pos",
    )


def scorer():
    """A scorer that rates by the first letter of the title."""

    def make_scorer():
        def reply(prompts):
            out = []
            for p in prompts:
                title = p.split("\n")[0].removeprefix("Title: ")
                severity = {"C": "CRITICAL", "H": "HIGH"}.get(title[0], "INFO")
                out.append(json.dumps({"severity": severity, "relevance_category": "OTHER", "relevance_score": 10}))
            return out

        return reply

    return make_scorer


def titles(store, spark, date):
    schema = "total_scraped bigint, total_included bigint, articles array<struct<title: string>>"
    page = tables.read_json(spark, store.path("digests", date, "digest_date"), schema).first()
    return page.total_scraped, page.total_included, [a.title for a in page.articles]


def test_three_days(spark, tmp_path):
    store = daily.Store(str(tmp_path))
    days = {
        "2026-04-18": {"rss": source(spark, "C1", "H1", "C1", "C2"), "nvd": source(spark, "C2", "C3", kind="nvd")},
        "2026-04-19": {"rss": source(spark, "C1", "C4"), "x": None},
        "2026-04-26": {"rss": source(spark, "C1", "C4")},
    }
    for date, sources in days.items():
        daily.run_day(spark, store, date, sources, scorer(), GENERATED, page_size=10)
    assert titles(store, spark, "2026-04-18") == (4, 3, ["C1", "C2", "C3"])
    assert titles(store, spark, "2026-04-19") == (1, 1, ["C4"])
    assert titles(store, spark, "2026-04-26") == (1, 1, ["C1"]), "C4 was sent seven days before, C1 eight"
    assert seen.read_sent(spark, store.path("sent_ids")).count() == 5
    raw = tables.read_raw(spark, store.path("raw"), "2026-04-18")
    assert raw.count() == 6 and raw.filter("source_type = 'nvd'").count() == 2
    text = spark.read.parquet(store.path("reports_text", "2026-04-18", "digest_date")).first().body
    assert "3 items included / 4 scraped" in text

    summary = daily.run_summary(spark, store, "2026-04-18").first().asDict()
    assert {k: summary[k] for k in ("raw", "unique", "quarantined", "processed", "included", "excluded")} == {
        "raw": 6, "unique": 4, "quarantined": 0, "processed": 4, "included": 3, "excluded": 1}

    # Running a day again gives the same digest.
    daily.run_day(spark, store, "2026-04-19", days["2026-04-19"], scorer(), GENERATED, page_size=10)
    assert titles(store, spark, "2026-04-19") == (1, 1, ["C4"])

    # Sent elsewhere between triage and digest: scraped, but not included.
    c4 = source(spark, "C4")
    seen.save_sent(c4, store.path("sent_ids"), "2026-04-17")
    daily.digest_day(spark, store, "2026-04-19", GENERATED)
    assert titles(store, spark, "2026-04-19") == (1, 0, [])


def test_missing_replies_are_quarantined(spark, tmp_path):
    store = daily.Store(str(tmp_path))
    articles = source(spark, "C1", "C2")
    replies = articles.filter("title = 'C1'").select("id", F.lit('{"severity": "CRITICAL"}').alias("response_text"))
    daily.run_day(spark, store, "2026-04-18", {"rss": articles}, replies, GENERATED)
    assert titles(store, spark, "2026-04-18") == (1, 1, ["C1"])
    assert [r.title for r in daily.read_quarantine(spark, store, "2026-04-18").collect()] == ["C2"]


def test_replay_equals_the_daily_runs(spark, tmp_path):
    store = daily.Store(str(tmp_path))
    plan = {1: "C1 H1 C2", 3: "C1 C3", 9: "C1 C2 C3", 11: "C3 C1"}
    rated = None
    for offset, names in plan.items():
        date = str(dt.date(2026, 4, 1) + dt.timedelta(days=offset))
        day = source(spark, *names.split())
        daily.run_day(spark, store, date, {"rss": day}, scorer(), GENERATED)
        scored = day.withColumns({
            "severity": F.when(F.col("title").startswith("C"), "CRITICAL").otherwise("HIGH"), "category": F.lit("OTHER"),
            "score": F.lit(10), "run_date": F.lit(date).cast("date")})
        rated = scored if rated is None else rated.union(scored)
    pages = daily.backfill_digests(policy.with_policy(rated), GENERATED, ["title"])
    replayed = {str(r.digest_date): (r.total_scraped, r.total_included, [a.title for a in r.articles]) for r in pages.collect()}
    assert replayed == {date: titles(store, spark, date) for date in replayed}
    assert len(replayed) == len(plan)


def test_a_day_without_articles_has_an_empty_digest(spark, tmp_path):
    store = daily.Store(str(tmp_path))
    daily.run_day(spark, store, "2026-04-18", {"rss": None}, "rules", GENERATED)
    assert titles(store, spark, "2026-04-18") == (0, 0, [])
    assert daily.run_summary(spark, store, "2026-04-18").first().raw == 0


def test_counts_of_a_run_equal_its_tables(spark, tmp_path):
    """Each step counts what it writes: the same figures as the tables give, a repeated day too."""
    store = daily.Store(str(tmp_path))
    for date, names in (("2026-04-18", "C1 H1 C1 C2"), ("2026-04-19", "C1 C4 I1 I2"), ("2026-04-19", "C1 C4 I1")):
        daily.run_day(spark, store, date, {"rss": source(spark, *names.split())}, scorer(), GENERATED)
    counted, scanned = daily.read_counts(spark, store, "2026-04-19").first(), daily.run_summary(spark, store, "2026-04-19").first()
    assert (counted.raw, counted.unseen, counted.included, counted.excluded) == (3, 2, 1, 1)
    assert all(counted[c] == scanned[c] for c in ("run_date", "raw", "quarantined", "included", "excluded"))
    assert daily.read_counts(spark, store, "2026-04-20").count() == 0
