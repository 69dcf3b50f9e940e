"""Whole runs: one day, and the replay of many days at once."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newsmill import schemas
from newsmill.functions.dates import recent
from newsmill.operators import digest, seen, triage
from newsmill.operators.dedup import dedup_first
from newsmill.session import configure, materialize
from newsmill.sources import cves, feeds, papers, registry, tables

DIGEST_FIELDS = ("id", "title", "url", "source", "source_type", "content", "published_at", "scraped_at",
                 "summary", "severity", "relevance", "affected_products")


@dataclass(frozen=True)
class Store:
    """Where the tables of a run live; each is partitioned by its date."""

    root: str

    def path(self, table: str, date: str | None = None, column: str = "run_date") -> str:
        base = f"{self.root.rstrip('/')}/{table}"
        return base if date is None else f"{base}/{column}={date}"


def run_day(
    spark: SparkSession,
    store: Store,
    date: str,
    sources: Mapping[str, DataFrame | None],
    scorer: DataFrame | Callable[[], triage.ReplyFunction] | str,
    generated_at: str,
    title: str = digest.TITLE,
    page_size: int = digest.PAGE_SIZE,
    errors: DataFrame | None = None,
) -> None:
    """Raw, processed, digest, report and sent-id tables of one date, and its scrape errors.

    Every step reads the table the step before it wrote, so a lost executor
    costs one step's tasks, a model is called once per article, and running
    the date again replaces its tables.
    """
    configure(spark)
    landed = Observation()
    tables.write_raw(tables.union_sources(sources).observe(landed, F.count("*").alias("raw")), store.path("raw"), date)
    if errors is not None:
        errors.write.mode("overwrite").parquet(store.path("errors", date))
    counts = landed.get | triage_day(spark, store, date, scorer) | digest_day(spark, store, date, generated_at, title, page_size)
    row = spark.createDataFrame([tuple(counts[c] for c in COUNTS)], ", ".join(f"{c} bigint" for c in COUNTS))
    row.write.mode("overwrite").parquet(store.path("counts", date))


#: Rows of a run that each step counts as it writes them.
COUNTS = ("raw", "unseen", "quarantined", "included", "excluded")


def read_counts(spark: SparkSession, store: Store, date: str) -> DataFrame:
    """What the steps of a finished day counted while they wrote, one row; no table of the day is read again."""
    schema = "run_date date, " + ", ".join(f"{c} bigint" for c in COUNTS)
    return tables.read_stored(spark, store.path("counts", date), schema, store.path("counts"))


def scrape(
    config: DataFrame, landed: Mapping[str, DataFrame], as_of: str, hours: float = 26, cve_hours: float | None = None
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Articles and errors of what has landed, as a run takes them.

    ``config`` is the registry; ``landed`` has the documents of ``rss``, ``nvd``
    and ``arxiv``. Articles of every source are those of the look-back of ``hours``
    (``cve_hours`` sets another one for vulnerabilities). Feeds and services that are
    switched off are not parsed; a service gives the one error that says so.
    """
    gates = registry.api_gates(config)
    docs = feeds.from_registry(landed["rss"], registry.enabled_rss(config))
    nvd, arxiv = (open_gate(landed[kind], gates, kind) for kind in ("nvd", "arxiv"))
    sources = {
        "rss": feeds.normalize_feeds(docs).filter(recent(F.col("published_at"), as_of, hours=hours)),
        "nvd": cves.recent_severe(cves.normalize_cves(nvd), as_of, hours=hours if cve_hours is None else cve_hours),
        "arxiv": papers.newest_on_topic(papers.normalize_papers(arxiv)).filter(recent(F.col("published_at"), as_of, hours=hours)),
    }
    return sources, scrape_errors(docs, nvd, arxiv, gates)


def open_gate(landed: DataFrame, gates: DataFrame, kind: str) -> DataFrame:
    """The documents of a service if it is switched on, else none."""
    on = gates.filter((F.col("source_type") == kind) & F.col("enabled")).select(F.col("source_type").alias("_kind")).distinct()
    return landed.withColumn("_kind", F.lit(kind)).join(on, "_kind", "left_semi").drop("_kind")


def scrape_errors(rss: DataFrame, nvd: DataFrame, arxiv: DataFrame, gates: DataFrame) -> DataFrame:
    """Errors of documents that are read (unreadable ones, bad dates), and services that are switched off."""
    off = gates.filter("not enabled").select("source_type", F.col("source_type").alias("source"), "error")
    return feeds.feed_errors(rss).unionByName(cves.cve_errors(nvd)).unionByName(papers.paper_errors(arxiv)).unionByName(off)


def triage_day(
    spark: SparkSession, store: Store, date: str, scorer: DataFrame | Callable[[], triage.ReplyFunction] | str
) -> dict[str, int]:
    """Deduplicate, drop what was sent, triage the rest; how many were triaged, and are in quarantine.

    Both reductions come before the scorer, the costly step. Articles without
    a reply go to the quarantine table. Rows are counted in the stage that writes them,
    whose tasks count once however often they run.
    """
    raw = dedup_first(tables.read_raw(spark, store.path("raw"), date))
    fresh = seen.unseen(raw, seen.seen_window(seen.read_sent(spark, store.path("sent_ids")), date)).drop("run_date")
    if callable(scorer):
        replies = store.path("responses", date)
        triage.score_with(fresh, scorer).select("id", "response_text").write.mode("overwrite").parquet(replies)
        scorer = spark.read.parquet(replies)
    seen_now = Observation()
    missing = F.count_if(F.col("triage_status") == "missing")
    done = triage.triage(fresh, scorer).observe(seen_now, F.count("*").alias("unseen"), missing.alias("quarantined"))
    done.write.mode("overwrite").partitionBy("triage_status").parquet(store.path("processed", date))
    return seen_now.get


def read_processed(spark: SparkSession, store: Store, date: str) -> DataFrame:
    """Analysed articles of a date; quarantined ones are in their own folder."""
    return _processed(spark, store, date).filter(F.col("triage_status") != "missing").drop("triage_status")


def read_quarantine(spark: SparkSession, store: Store, date: str) -> DataFrame:
    return _processed(spark, store, date).filter(F.col("triage_status") == "missing")


def _processed(spark: SparkSession, store: Store, date: str) -> DataFrame:
    schema = schemas.ANALYZED + ", triage_status string"
    return spark.read.schema(schema).parquet(store.path("processed", date))


def rate_day(spark: SparkSession, store: Store, date: str) -> DataFrame:
    """Analysed articles with policy columns, after the second seen check.

    What was sent meanwhile still counts as scraped but is not included.
    """
    sent = seen.seen_window(seen.read_sent(spark, store.path("sent_ids")), date).withColumn("already_sent", F.lit(True))
    rated = digest.rate(read_processed(spark, store, date)).join(sent, "id", "left")
    return rated.withColumns(
        {
            "included": F.col("included") & F.col("already_sent").isNull(),
            "digest_date": F.lit(date).cast("date"),
        }
    )


def digest_day(
    spark: SparkSession, store: Store, date: str, generated_at: str,
    title: str = digest.TITLE, page_size: int = digest.PAGE_SIZE,
) -> dict[str, int]:
    """Rank once into a table, and make every output from it; how many articles were included and excluded."""

    def write(df: DataFrame, table: str) -> DataFrame:
        path = store.path(table, date, "digest_date")
        df.drop("digest_date").write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).option("basePath", store.path(table)).parquet(path)

    # The date is named, so a day without articles has an empty digest.
    day = spark.range(1).select(F.lit(date).cast("date").alias("digest_date"))
    judged = Observation()
    included, excluded = F.count_if("included").alias("included"), F.count_if(~F.col("included")).alias("excluded")
    rated = write(rate_day(spark, store, date).observe(judged, included, excluded), "rated")
    made = digest.prepare(rated, day)
    made = digest.Digest(write(made.totals, "totals"), write(made.ranked, "ranked"))
    pages = digest.digest_pages(made, generated_at, DIGEST_FIELDS, page_size)
    tables.write_json(pages, store.path("digests", date, "digest_date"))
    for kind, render in (("text", digest.render_text), ("html", digest.render_html)):
        write(render(made, title, page_size=page_size), f"reports_{kind}")
    write(digest.digest_subjects(made.totals, title), "subjects")
    seen.save_sent(made.ranked, store.path("sent_ids"), date)
    return judged.get


def replay(rated: DataFrame, lookback: int = seen.LOOKBACK_DAYS) -> DataFrame:
    """Many days of rated articles as their daily runs would have left them.

    Keeps the first copy per date, drops what was sent in the days before,
    and sets ``included`` to what was sent. All days go through one shuffle
    by id instead of one run after the other.
    """
    unique = dedup_first(rated, ["id", "run_date"])
    decisions = seen.send_decisions(unique.select("id", "run_date", "included"), lookback)
    fresh = decisions.filter(~F.col("seen")).select("id", "run_date", "sent")
    return unique.drop("included").join(fresh, ["id", "run_date"]).withColumnRenamed("sent", "included")


def backfill_digests(
    rated: DataFrame, generated_at: str, fields: Sequence[str], page_size: int = digest.PAGE_SIZE
) -> DataFrame:
    """Digest records of every replayed day; ``digest_date`` is the run date.

    The replay is stored first, because ranking and totals both read it.
    """
    needed = {"severity", "severity_rank", "score", "source_ord", "pos", "included", *fields}
    days = replay(rated).withColumn("digest_date", F.col("run_date")).select("digest_date", *sorted(needed))
    return digest.digest_pages(digest.prepare(materialize(days, "replay")), generated_at, fields, page_size)


def run_summary(spark: SparkSession, store: Store, date: str) -> DataFrame:
    """Row counts of a finished day, one row.

    ``excluded`` includes what was already sent when the digest was made.
    """
    raw = tables.read_raw(spark, store.path("raw"), date)
    rated = spark.read.parquet(store.path("rated", date, "digest_date"))
    raw_counts = raw.groupBy("id").agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw"), F.count("*").alias("unique")
    )
    missing = read_quarantine(spark, store, date).agg(F.count("*").alias("quarantined"))
    done = rated.agg(
        F.count("*").alias("processed"),
        F.count_if("included").alias("included"),
        F.count_if(~F.col("included")).alias("excluded"),
    )
    # Three single-row aggregates side by side.
    summary = raw_counts.withColumn("_one", F.lit(1))
    for part in (missing, done):
        summary = summary.join(part.withColumn("_one", F.lit(1)), "_one")
    return summary.select(F.lit(date).cast("date").alias("run_date"), *summary.drop("_one").columns)
