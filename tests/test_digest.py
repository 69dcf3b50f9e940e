import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsmill.operators import digest, policy

DATE = "2026-04-18"


def rated(spark, *rows, date=DATE):
    schema = """id string, title string, summary string, severity string, category string, score int,
                affected_products array<string>, source string, url string, source_ord int, pos bigint"""
    full = [(str(i), t, f"About {t}.", s, c, n, p, "Feed", f"https://e.com/{i}", 0, i) for i, (t, s, c, n, p) in enumerate(rows)]
    df = spark.createDataFrame(full, schema).withColumns(
        {
            "digest_date": F.lit(date).cast("date"),
            "published_at": F.lit("2026-04-08 09:00:00").cast("timestamp"),
        }
    )
    return policy.with_policy(df)


THREE = (
    ("Bucket flaw", "HIGH", "AWS_SECURITY", 80, ["S3"]),
    ("Left out", "LOW", "OTHER", 10, []),
    ("Jailbreak <new>", "MEDIUM", "AI_GENERAL", 70, []),
    ("RCE & more", "CRITICAL", "BEDROCK_AGENTCORE", 98, ["AWS Bedrock", "Agent Core SDK"]),
)


def whole(pages):
    """Bodies per date, page after page."""
    out = {}
    for r in sorted(pages.collect(), key=lambda r: (r.digest_date, r.page)):
        out[str(r.digest_date)] = out.get(str(r.digest_date), "") + r.body
    return out


def test_text(spark):
    body = whole(digest.render_text(digest.prepare(rated(spark, *THREE)), "Daily News", ["Stop: write to us"]))[DATE]
    assert body == "\n".join(
        [
            "=" * 60,
            "DAILY NEWS — 2026-04-18",
            "3 items included / 4 scraped",
            "=" * 60,
            "",
            "[CRITICAL] [BEDROCK] RCE & more",
            "About RCE & more.",
            "Affected: AWS Bedrock, Agent Core SDK",
            "Source: Feed — https://e.com/3",
            "Published: Apr 8, 2026",
            "",
            "[HIGH] [AWS] Bucket flaw",
            "About Bucket flaw.",
            "Affected: S3",
            "Source: Feed — https://e.com/0",
            "Published: Apr 8, 2026",
            "",
            "[MEDIUM] [AI] Jailbreak <new>",
            "About Jailbreak <new>.",
            "Source: Feed — https://e.com/2",
            "Published: Apr 8, 2026",
            "",
            "-" * 60,
            "Daily News",
            "Stop: write to us",
        ]
    )


def test_html(spark):
    body = whole(digest.render_html(digest.prepare(rated(spark, *THREE))))[DATE]
    assert body.startswith("<!DOCTYPE html>") and body.rstrip().endswith("</html>")
    for part in (
        'href="https://e.com/3"', "RCE &amp; more", "Jailbreak &lt;new&gt;", "3 included", "4 scraped",
        "#dc2626", "#ea580c", "BEDROCK", "Affected: AWS Bedrock, Agent Core SDK", "Apr 8, 2026", DATE,
    ):
        assert part in body, part
    assert "<new>" not in body and "Left out" not in body
    assert body.count(digest.ROW_SEPARATOR) == 2
    stats = body[: body.index("<table>")]
    assert stats.index("CRITICAL") < stats.index("HIGH") < stats.index("MEDIUM")
    assert "LOW" not in stats and "INFO" not in stats


@pytest.mark.parametrize("render", [digest.render_text, digest.render_html])
def test_pages_concatenate_to_the_single_page_body(spark, render):
    rows = digest.prepare(rated(spark, *(THREE * 4)))
    parts = render(rows, page_size=5)
    assert parts.count() == 3
    assert whole(parts) == whole(render(rows))


def test_empty_digest(spark):
    rows = digest.prepare(rated(spark, ("Only", "INFO", "OTHER", 0, [])))
    assert "0 items included / 1 scraped" in whole(digest.render_text(rows))[DATE]
    assert "</html>" in whole(digest.render_html(rows))[DATE]
    page = digest.digest_pages(rows, "2026-04-18 07:00:00", ["id", "title"]).first()
    assert (page.total_scraped, page.total_included, page.page, page.last_page, page.articles) == (1, 0, 0, 0, [])


def test_digest_pages(spark):
    rows = rated(spark, *THREE).unionByName(rated(spark, THREE[0], date="2026-04-19"))
    found = {str(r.digest_date): r for r in digest.digest_pages(digest.prepare(rows), "2026-04-19 07:00:00", ["title", "score"]).collect()}
    first = found[DATE]
    assert [a.title for a in first.articles] == ["RCE & more", "Bucket flaw", "Jailbreak <new>"]
    assert (first.total_scraped, first.total_included) == (4, 3)
    assert first.generated_at == dt.datetime(2026, 4, 19, 7)
    assert len(found["2026-04-19"].articles) == 1


def test_subjects(spark):
    rows = rated(spark, *THREE).unionByName(rated(spark, THREE[0], date="2026-04-19"))
    found = {r.subject for r in digest.digest_subjects(digest.digest_totals(rows), "News").collect()}
    assert found == {"News — 2026-04-18 (3 items)", "News — 2026-04-19 (1 item)"}


def test_severity_counts(spark):
    rows = rated(spark, *(THREE + THREE[:1])).filter("included")
    counts = digest.severity_counts(rows).orderBy(F.desc("severity_rank")).collect()
    assert [(r.severity, r.n) for r in counts] == [("CRITICAL", 1), ("HIGH", 2), ("MEDIUM", 1)]


def test_pages_of_one_date_are_in_many_tasks(spark, monkeypatch):
    """A date's pages meet its totals where they are; a date without articles still has its empty page."""
    many = rated(spark, *[(f"t{i}", "HIGH", "AWS_SECURITY", i % 20 + 80, []) for i in range(200)])
    empty = spark.createDataFrame([("2026-04-19",), (DATE,)], "d string").select(F.col("d").cast("date").alias("digest_date"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(before, ("false", "-1"), strict=True):
            spark.conf.set(k, v)
        made = digest.prepare(many, empty)
        pages = digest.digest_pages(made, "2026-04-20 00:00:00", ["id"], page_size=5).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    of = {d: [r for r in pages if str(r.digest_date) == d] for d in (DATE, "2026-04-19")}
    n = of[DATE][0].total_included
    assert n == 200 and sorted(r.page for r in of[DATE]) == list(range(n // 5)) and all(len(r.articles) == 5 and r.last_page == 39 for r in of[DATE])
    assert len({r.task for r in of[DATE]}) > 3
    assert [(r.page, r.last_page, r.articles) for r in of["2026-04-19"]] == [(0, 0, [])]
