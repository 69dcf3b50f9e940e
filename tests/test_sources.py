import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from newsmill import schemas
from newsmill.sources import cves, feeds, papers, registry, tables

SCRAPED = dt.datetime(2026, 4, 19, 6)


def landed(spark, *bodies, source="Test Feed"):
    rows = [(source, body, i) for i, body in enumerate(bodies)]
    df = spark.createDataFrame(rows, "source_name string, body string, doc_pos bigint")
    return df.withColumn("scraped_at", F.lit("2026-04-19 06:00:00").cast("timestamp"))


def articles(df):
    return df.withColumn("published_at", F.col("published_at").cast("timestamp_ntz")).orderBy("pos").collect()


RSS = """<?xml version="1.0"?>
<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>Feed</title>
<item><title>One &amp;amp; only</title><link> https://example.com/1 </link>
  <description>&lt;p&gt;A &lt;b&gt;bold&lt;/b&gt; claim.&lt;/p&gt;</description>
  <pubDate>Fri, 18 Apr 2026 08:00:00 +0000</pubDate></item>
<item><title>Two</title><link>https://example.com/2</link><description>short</description>
  <content:encoded><![CDATA[<div>long &nbsp; text</div>]]></content:encoded></item>
<item><title>Three</title><link>https://example.com/3</link><description>ignored</description>
  <content:encoded></content:encoded><pubDate>never</pubDate></item>
<item><title>No link</title><description>x</description></item>
<item><title>Blank link</title><link>  </link></item>
<item><link>https://example.com/1</link></item>
</channel></rss>"""

ATOM = """<?xml version="1.0" encoding="utf-8"?>
<!-- generated --><feed xmlns="http://www.w3.org/2005/Atom"><title>Feed</title>
<entry><title type="html">First</title><link rel="related" href="https://example.com/r"/>
  <link rel="alternate" href="https://example.com/first" type="text/html"/>
  <summary type="html">&lt;p&gt;Sum&lt;/p&gt;</summary><content>Full</content>
  <published>2026-04-18T09:00:00Z</published><updated>2026-04-18T10:00:00Z</updated></entry>
<entry><title>Second</title><link href="https://example.com/second"/><summary>S</summary>
  <updated>2026-04-17T15:00:00Z</updated></entry>
<entry><title>Related only</title><link rel="related" href="https://example.com/x"/></entry>
<entry><title>Empty first</title><link href=""/><link href="https://example.com/later"/></entry>
</feed>"""


def test_rss(spark):
    rows = articles(feeds.normalize_feeds(landed(spark, RSS)))
    assert [r.url for r in rows] == [f"https://example.com/{i}" for i in (1, 2, 3, 1)]
    assert rows[0].title == "One & only"
    assert rows[0].content == "A bold claim."
    assert rows[0].id == hashlib.sha256(b"https://example.com/1").hexdigest()
    assert rows[0].published_at == dt.datetime(2026, 4, 18, 8)
    assert (rows[0].source, rows[0].source_type) == ("Test Feed", "rss")
    assert rows[1].content == "long text"
    assert rows[2].content == "", "an empty content:encoded wins over the description"
    assert rows[1].published_at == rows[2].published_at == SCRAPED
    assert (rows[3].title, rows[3].content) == ("", "")


def test_atom(spark):
    rows = articles(feeds.normalize_feeds(landed(spark, ATOM)))
    assert [(r.title, r.url, r.content) for r in rows] == [
        ("First", "https://example.com/first", "Full"),
        ("Second", "https://example.com/second", "S"),
    ]
    assert [r.published_at for r in rows] == [dt.datetime(2026, 4, 18, 9), dt.datetime(2026, 4, 17, 15)]


def test_single_item_and_dispatch(spark):
    one = "<rss><channel><item><title>T</title><link>https://e.com/</link></item></channel></rss>"
    rdf = "<rdf:RDF xmlns:rdf='r'><channel/><item><link>https://e.com/</link></item></rdf:RDF>"
    fake = "<other><channel><item><link>https://e.com/</link></item></channel></other>"
    df = landed(spark, one, rdf, fake, "<unknown><data/></unknown>", "<rss><channel/></rss>", "<feed/>", "﻿" + one)
    assert [r.url for r in articles(feeds.normalize_feeds(df))] == ["https://e.com/"] * 2


def test_feed_errors_do_not_stop_other_feeds(spark):
    df = landed(spark, "<rss><channel><item>", "plain text", None, "  ", RSS)
    errors = sorted(r.error for r in feeds.feed_errors(df).collect())
    assert errors == [
        "Test Feed: empty document",
        "Test Feed: empty document",
        "Test Feed: malformed XML",
        "Test Feed: not an XML document",
    ]
    assert feeds.normalize_feeds(df).count() == 4


PAPERS = """<feed xmlns="http://www.w3.org/2005/Atom">
<entry><id>http://arxiv.org/abs/2404.01234v1</id><title>Adversarial
  attacks</title><summary> On
 models </summary><published>2026-04-18T09:00:00Z</published><category term="cs.CR"/><category term="cs.LG"/></entry>
<entry><id>http://arxiv.org/abs/2404.05678v2</id><title>Air safety</title><summary/><updated>2026-04-17T09:00:00Z</updated>
<category term="cs.AI"/></entry>
<entry><id> </id><title>none</title></entry>
<entry><id>http://arxiv.org/abs/1</id><title>Undated security</title><category term="cs.DB"/></entry>
<entry><id>http://arxiv.org/abs/2</id><title>Bad date</title><published>x</published></entry>
</feed>"""


def test_papers(spark):
    df = landed(spark, PAPERS, "<feed></feed>")
    rows = articles(papers.normalize_papers(df))
    assert [(r.url, r.title, r.content) for r in rows] == [
        ("https://arxiv.org/abs/2404.01234", "Adversarial attacks", "On models"),
        ("https://arxiv.org/abs/2404.05678", "Air safety", ""),
        ("https://arxiv.org/abs/1", "Undated security", ""),
    ]
    assert [r.published_at for r in rows] == [dt.datetime(2026, 4, 18, 9), dt.datetime(2026, 4, 17, 9), SCRAPED]
    assert rows[0].source == "ArXiv" and rows[0].source_type == "arxiv"
    assert [r.error for r in papers.paper_errors(df).collect()] == ["ArXiv: invalid date x in https://arxiv.org/abs/2"]
    assert [r.title for r in papers.newest_on_topic(papers.normalize_papers(df)).collect()] == ["Adversarial attacks"]


def test_newest_is_limited_and_sorted(spark):
    df = spark.range(300).select(
        F.concat(F.lit("id"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("id"),
        F.lit("LLM security").alias("title"),
        F.array(F.lit("cs.AI")).alias("categories"),
        F.timestamp_seconds(F.col("id") % 150).alias("published_at"),
    )
    rows = papers.newest_on_topic(df).collect()
    assert len(rows) == 100
    assert [r.id for r in rows[:4]] == ["id149", "id299", "id148", "id298"]


def cve(cve_id="CVE-2026-1", **extra):
    base = {"id": cve_id, "published": "2026-04-18T10:00:00.000", "descriptions": [{"lang": "en", "value": "A flaw."}]}
    return {"cve": {**base, **extra}}


def metric(score, severity):
    return [{"cvssData": {"baseScore": score, "baseSeverity": severity}}]


def page(*records):
    return json.dumps({"totalResults": len(records), "startIndex": 0, "resultsPerPage": 2000, "vulnerabilities": records})


def test_cves(spark):
    both = {"cvssMetricV31": metric(9.8, "CRITICAL"), "cvssMetricV30": metric(5.0, "MEDIUM")}
    body = page(
        cve(metrics=both),
        cve("CVE-2", metrics={"cvssMetricV30": metric(7.5, "HIGH")}),
        cve("CVE-3", metrics={"cvssMetricV31": [], "cvssMetricV30": metric(9.0, "CRITICAL")}),
        cve("CVE-4"),
        cve("CVE-5", descriptions=[{"lang": "es", "value": "no"}], metrics={"cvssMetricV31": metric(8.1, "HIGH")}),
        cve("CVE-6", published="2026-04-18T10:00:00.000Z"),
    )
    rows = articles(cves.normalize_cves(landed(spark, body)))
    assert [r.content for r in rows] == [
        "CVSS 9.8 (CRITICAL). A flaw.",
        "CVSS 7.5 (HIGH). A flaw.",
        "CVSS 9 (CRITICAL). A flaw.",
        "A flaw.",
        "CVSS 8.1 (HIGH). ",
        "A flaw.",
    ]
    assert {r.published_at for r in rows} == {dt.datetime(2026, 4, 18, 10)}
    assert rows[0].url == "https://nvd.nist.gov/vuln/detail/CVE-2026-1"
    assert (rows[0].title, rows[0].source, rows[0].source_type) == ("CVE-2026-1", "NVD", "nvd")


def test_recent_severe(spark):
    high = {"cvssMetricV31": metric(7.5, "HIGH")}
    body = page(
        cve("in", metrics=high),
        cve("old", metrics=high, published="2026-04-01T00:00:00.000"),
        cve("future", metrics=high, published="2026-04-20T00:00:00.000"),
        cve("medium", metrics={"cvssMetricV31": metric(5.0, "MEDIUM")}),
        cve("rejected", metrics=high, vulnStatus="Rejected"),
        cve("unrated"),
    )
    found = cves.recent_severe(cves.normalize_cves(landed(spark, body)), "2026-04-19 06:00:00")
    assert [r.title for r in found.collect()] == ["in"]


def test_cve_errors(spark):
    df = landed(spark, "not json", page(cve("CVE-9", published="x")), page(cve()))
    assert sorted(r.error for r in cves.cve_errors(df).collect()) == [
        "NVD: invalid date x in CVE-9",
        "NVD: unreadable page",
    ]
    assert cves.normalize_cves(df).count() == 1


def registry_file(tmp_path, **config):
    path = tmp_path / "sources.json"
    path.write_text(json.dumps({"rss": [], "apis": [], "social": [], **config}, indent=1))
    return str(path)


def test_registry(spark, tmp_path):
    path = registry_file(
        tmp_path,
        rss=[
            {"name": "A", "url": "https://a", "enabled": True},
            {"name": "B", "url": "https://b", "enabled": False},
            {"name": "C", "url": "https://c", "enabled": True},
        ],
        apis=[{"name": "N", "type": "nvd", "enabled": False}, {"name": "N2", "type": "nvd", "enabled": True}],
    )
    config = registry.read_registry(spark, path)
    assert [(r.registry_pos, r.name) for r in registry.enabled_rss(config).collect()] == [(0, "A"), (2, "C")]
    gates = {r.source_type: (r.enabled, r.error) for r in registry.api_gates(config).collect()}
    assert gates == {
        "nvd": (False, "NVD source is disabled in sources.json"),
        "arxiv": (False, "ArXiv source is disabled in sources.json"),
    }
    bodies = landed(spark, RSS, source="C").withColumn("file", F.lit("b.xml"))
    two = bodies.unionByName(bodies.withColumn("file", F.lit("a.xml")))
    entries = registry.enabled_rss(config)
    found = feeds.from_registry(two, entries.unionByName(entries.withColumn("registry_pos", F.col("registry_pos") + 5)))
    assert sorted(r.doc_pos for r in found.collect()) == [2 * feeds.FILES, 2 * feeds.FILES + 1]
    positions = [r.pos for r in feeds.normalize_feeds(found).collect()]
    assert len(positions) == len(set(positions)) == 8
    off = feeds.from_registry(landed(spark, RSS, source="B").withColumn("file", F.lit("x")), registry.enabled_rss(config))
    assert feeds.normalize_feeds(off).count() == 0


def test_registry_without_enabled_feeds(spark, tmp_path):
    config = registry.read_registry(spark, registry_file(tmp_path))
    assert registry.enabled_rss(config).count() == 0


def test_landed_files(spark, tmp_path):
    for name, body in (("Feed One", RSS), ("Two", ATOM)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "body.xml").write_text(body)
    df = feeds.read_landed(spark, str(tmp_path))
    assert {r.source_name for r in df.collect()} == {"Feed One", "Two"}
    assert feeds.normalize_feeds(df.withColumn("doc_pos", F.lit(0))).count() == 6


def test_union_keeps_duplicates_and_order(spark):
    rss = feeds.normalize_feeds(landed(spark, RSS))
    merged = tables.union_sources({"arxiv": papers.normalize_papers(landed(spark, PAPERS)), "rss": rss, "x": None})
    rows = merged.orderBy("source_ord", "pos").collect()
    assert [r.source_type for r in rows] == ["rss"] * 4 + ["arxiv"] * 3
    assert tables.union_sources({"rss": None}).count() == 0
    with pytest.raises(ValueError):
        tables.union_sources({"fax": rss})


def test_raw_round_trip_replaces_a_date(spark, tmp_path):
    root = str(tmp_path / "raw")
    df = feeds.normalize_feeds(landed(spark, RSS))
    tables.write_raw(df, root, "2026-04-18")
    tables.write_raw(df, root, "2026-04-19")
    tables.write_raw(df.limit(1), root, "2026-04-19")
    back = tables.read_raw(spark, root, "2026-04-19")
    assert back.count() == 1 and str(back.first().run_date) == "2026-04-19"
    assert back.select(*df.columns).schema == df.schema or set(df.columns) <= set(back.columns)
    assert tables.read_raw(spark, root, "2026-04-18").count() == 4


def test_json_records(spark, tmp_path):
    df = tables.article_columns(feeds.normalize_feeds(landed(spark, RSS)))
    tables.write_json(df, str(tmp_path / "lines"))
    back = tables.read_json(spark, str(tmp_path / "lines"), schemas.ARTICLE)
    assert sorted(back.collect()) == sorted(df.select(*back.columns).collect())

    array = tmp_path / "array.json"
    array.write_text(json.dumps([{"id": "a", "sent_date": "2026-04-18"}, {"id": "b", "sent_date": "2026-04-18"}]))
    assert tables.read_json(spark, str(array), schemas.SENT_ID, arrays=True).count() == 2

    (tmp_path / "empty.json").write_text("")
    with pytest.raises(ValueError, match="empty file"):
        tables.read_json(spark, str(tmp_path / "*.json"), schemas.SENT_ID, arrays=True)


def test_errors_of_all_sources(spark):
    listing = landed(spark, "<feed><entry>").unionByName(landed(spark, "no xml")).unionByName(landed(spark, ""))
    assert sorted(r.error for r in papers.paper_errors(listing).collect()) == [
        "ArXiv: empty document", "ArXiv: malformed XML", "ArXiv: not a listing",
    ]
    record = '{"cve": {"id": "CVE-1", "published": "2026-01-01T00:00:00.000", "metrics": {"cvssMetricV31": [{"cvssData": {"baseScore": %s}}]}}}'
    page = landed(spark, '{"vulnerabilities": [%s]}' % (record % "9.0"))
    assert [r.content for r in cves.normalize_cves(page).collect()] == ["CVSS 9. "]
    assert cves.cve_errors(page).count() == 0
    odd = landed(spark, '{"vulnerabilities": [%s]}' % (record % '"high"'))
    assert [r.error for r in cves.cve_errors(odd).collect()] == ["NVD: unreadable page"]


def test_positions_that_do_not_fit_raise(spark):
    from newsmill.functions.text import item_pos

    for doc, item in ((1, 1 << 20), (1 << 40, 0)):
        with pytest.raises(Exception, match="too many"):
            spark.range(1).select(item_pos(F.lit(doc), F.lit(item))).collect()
    assert spark.range(1).select(item_pos(F.lit(1), F.lit(5)).alias("p")).first().p == (1 << 20) + 5


def test_landed_feed_files_follow_the_size_of_a_source(spark, tmp_path, monkeypatch):
    """Neither gaps between the numbers of documents nor other sources make more files; a large source has several."""
    from newsmill.plans import views

    rows = [(i * 1000, "small" if i % 2 else "other", f"one line\nline {i}") for i in range(40)]
    rows += [(7 + i, "large", "x" * 500) for i in range(40)] + [(99, "empty", None)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(views, "FILE_BYTES", 5000)
    views.land_feeds(spark, str(tmp_path), f"{tmp_path}/feeds")
    landed = feeds.read_landed(spark, f"{tmp_path}/feeds")
    files = {r.source_name: r["count"] for r in landed.groupBy("source_name").count().collect()}
    assert files.pop("large") in (3, 4, 5) and files == {"small": 1, "other": 1, "empty": 1}
    numbered = landed.withColumn("doc_pos", F.lit(0).cast("bigint"))
    titles = {r.title for r in feeds.normalize_feeds(numbered.select("source_name", "body", "scraped_at", "doc_pos")).collect()}
    assert titles == {f"Item {d}-{i}" for d, _, text in rows if text for i in range(len(text.split("\n")))}
