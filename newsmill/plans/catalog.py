"""The registered queries: each runs one operator over a whole given table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill import schemas
from newsmill.functions.dates import display_date, iso_millis, recent, run_date
from newsmill.functions.text import article_id, paper_url, strip_html
from newsmill.operators import digest, metrics, policy, retention, seen, sketches, stats, triage
from newsmill.operators.dedup import dedup_first
from newsmill.operators.quantile import selected_quantile
from newsmill.plans import daily, views
from newsmill.session import configure, materialize, work_dir
from newsmill.sources import cves, feeds, papers, registry, tables
from newsmill.streaming import alarms, budget, ingest, late
from newsmill.streaming import replies as reply_stream
from newsmill.streaming import seen as seen_stream
from newsmill.streaming.memory import Memory
from newsmill.streaming.runs import Step, drain, read_batches, write_available, write_batches

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-01-20 06:00:00"
LATE_REPORT_DATE = "2024-04-12"
STORED_DAYS = ("2024-01-03", "2024-01-06", "2024-01-08", "2024-01-10")


def rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy.with_policy(views.analyzed(spark, sf_dir))


def included(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rated(spark, sf_dir).filter("included")


def sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return included(spark, sf_dir).select("id", F.col("digest_date").alias("sent_date")).distinct()


def source_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    registries = views.registries(spark, sf_dir)
    entries = registry.enabled_rss(registries, "registry").select(
        "registry", F.lit("rss").alias("kind"), "name", "enabled", F.lit(None).cast("string").alias("error")
    )
    gates = registry.api_gates(registries, "registry").select(
        "registry", F.lit("api").alias("kind"), F.col("source_type").alias("name"), "enabled", "error"
    )
    return entries.unionByName(gates)


def enabled_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of the feeds that are switched on."""
    sources = registry.enabled_rss(views.registries(spark, sf_dir)).select("name").distinct()
    return views.articles(spark, sf_dir).join(sources.withColumnRenamed("name", "source"), "source", "left_semi").select(
        "id", "source", "pos"
    )


def _feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.feeds(spark, sf_dir, partitions=spark.sparkContext.defaultParallelism)


def _papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.papers(spark, sf_dir, partitions=spark.sparkContext.defaultParallelism)


def _cves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.cves(spark, sf_dir, partitions=spark.sparkContext.defaultParallelism)


def feed_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.normalize_feeds(_feeds(spark, sf_dir)).select(
        "id", "title", "url", "source", "content", iso_millis(F.col("published_at")).alias("published"), "pos"
    )


def arxiv_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers.normalize_papers(_papers(spark, sf_dir)).select(
        "id", "title", "url", "content", iso_millis(F.col("published_at")).alias("published"), "pos"
    )


def paper_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = papers.newest_on_topic(papers.normalize_papers(_papers(spark, sf_dir)))
    return newest.select("id", "title", iso_millis(F.col("published_at")).alias("published"))


def cve_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cves.normalize_cves(_cves(spark, sf_dir)).select(
        "id", "title", "url", "content", iso_millis(F.col("published_at")).alias("published"), "pos", "base_severity"
    )


def cve_recent_severe(spark: SparkSession, sf_dir: str) -> DataFrame:
    severe = cves.recent_severe(cves.normalize_cves(_cves(spark, sf_dir)), AS_OF, hours=48)
    return severe.select("id", "title", "content", "base_severity")


def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = {
        "rss": feeds.normalize_feeds(_feeds(spark, sf_dir)),
        "nvd": cves.normalize_cves(_cves(spark, sf_dir)),
        "arxiv": papers.normalize_papers(_papers(spark, sf_dir)),
        "x": None,
    }
    merged = tables.union_sources(parts)
    return merged.groupBy("source_ord", "source_type", "source").agg(
        F.count("*").alias("n_rows"), F.sum(F.length("content")).alias("n_chars")
    )


def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "json")
    nested = views.analyzed(spark, sf_dir).withColumn(
        "relevance", F.struct("category", "score", F.lit("rated").alias("reasoning"))
    )
    tables.write_json(nested.drop("category", "score", "run_date", "digest_date"), path)
    back = tables.read_json(spark, path, schemas.ANALYZED)
    return back.select(
        "id", "title", "content", iso_millis(F.col("published_at")).alias("published"), "pos", "severity",
        F.col("relevance.category").alias("category"), F.col("relevance.score").alias("score"),
        F.array_join("affected_products", ",").alias("products"),
    )


def strip_html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = views.table(spark, sf_dir, "pages")
    return pages.select("page_id", strip_html(F.col("html")).alias("stripped"))


def article_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = views.table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", article_id(F.col("url")).alias("id"))


def normalize_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("  http://arxiv.org/abs/2401."), F.col("page_id").cast("string"), F.lit("v"),
                   (F.col("page_id") % 4).cast("string"), F.lit("\n"))
    pages = views.table(spark, sf_dir, "pages")
    return pages.select("page_id", paper_url(raw).alias("paper_url"), paper_url(F.col("url")).alias("page_url"))


def lookback_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = views.articles(spark, sf_dir).filter(recent(F.col("published_at"), AS_OF, hours=26))
    return chosen.select("pos", "id", iso_millis(F.col("published_at")).alias("published"))


def policy_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy.policy_filter(views.analyzed(spark, sf_dir)).select("pos", "id", "severity", "category", "score")


def rank_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.rank_articles(included(spark, sf_dir)).select("digest_date", "rank", "pos", "id", "severity", "score")


def rank_small_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rank_articles`` with blocks of four positions, so that ranks add up over many of them."""
    ranked = digest.rank_articles(included(spark, sf_dir), block_bits=2)
    return ranked.select("digest_date", "rank", "pos", "id", "severity", "score")


def stored_rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rated articles without their contents, stored once for totals and ranking."""
    return materialize(rated(spark, sf_dir).drop("content"), "rated")


def digest_daily(spark: SparkSession, sf_dir: str, page_size: int = digest.PAGE_SIZE) -> DataFrame:
    dated = rated(spark, sf_dir).drop("content").withColumn("digest_date", run_date(iso_millis(F.col("published_at"))))
    fields = ["id", "title", "url", "severity", "category", "score", "summary"]
    pages = digest.digest_pages(digest.prepare(materialize(dated, "rated")), AS_OF, fields, page_size)
    return pages.select(
        F.col("digest_date").cast("string").alias("digest_date"),
        "page",
        "total_scraped",
        "total_included",
        F.array_join(F.transform("articles", lambda a: F.concat(a["id"], F.lit(":"), a["title"])), ",").alias("articles"),
    )


def digest_small_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``digest_daily`` on pages of three articles."""
    return digest_daily(spark, sf_dir, page_size=3)


def digest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy.include_counts(views.analyzed(spark, sf_dir), ["digest_date"])


def severity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.severity_counts(included(spark, sf_dir))


def digest_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.digest_subjects(digest.digest_totals(rated(spark, sf_dir)))


def render_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = digest.render_text(digest.prepare(stored_rated(spark, sf_dir)))
    return body.select("digest_date", "page", F.sha2("body", 256).alias("body_sha"), F.length("body").alias("body_len"))


def render_small_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both reports on pages of three articles."""
    made = digest.prepare(stored_rated(spark, sf_dir))
    parts = [
        render(made, page_size=3).select("digest_date", F.lit(kind).alias("kind"), "page", F.sha2("body", 256).alias("body_sha"))
        for kind, render in (("text", digest.render_text), ("html", digest.render_html))
    ]
    return parts[0].unionByName(parts[1])


def render_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = digest.render_html(digest.prepare(stored_rated(spark, sf_dir)))
    return body.select("digest_date", "page", F.sha2("body", 256).alias("body_sha"), F.length("body").alias("body_len"))


def dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_first(views.articles(spark, sf_dir)).select("id", "pos", "source_ord", "title", "content")


def appearances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rated(spark, sf_dir).select("id", "run_date", "included", "source_ord", "pos")


def run_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.run_funnel(appearances(spark, sf_dir))


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All articles as one day's run, from raw rows to reports; what its steps counted as they wrote."""
    articles = views.articles(spark, sf_dir)
    by_type = {kind: articles.filter(F.col("source_type") == kind) for kind in schemas.SOURCE_TYPES}
    replies = views.responses(materialize(dedup_first(articles).select("id", "pos"), "unique"))
    store = daily.Store(work_dir(spark, "day"))
    daily.run_day(spark, store, AS_OF[:10], by_type, replies, AS_OF)
    return daily.read_counts(spark, store, AS_OF[:10])


def landing_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model replies that could not be used, as errors of their source type."""
    failed = parsed_replies(spark, sf_dir).filter("triage_status <> 'parsed'")
    return failed.select("source_type", F.concat("source", F.lit(": "), "triage_status").alias("error"), "pos")


def _damaged(documents: DataFrame, every: int, chars: int) -> DataFrame:
    """Landed documents of which every so many are cut off before their end."""
    body = F.when(F.pmod("doc_pos", F.lit(every)) == 0, F.expr(f"left(body, char_length(body) - {chars})")).otherwise(F.col("body"))
    return documents.withColumn("body", body)


def scrape_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = daily.scrape_errors(
        _damaged(_feeds(spark, sf_dir), 7, 12),
        _damaged(_cves(spark, sf_dir), 13, 5),
        _damaged(_papers(spark, sf_dir), 11, 9),
        registry.api_gates(views.registries(spark, sf_dir)),
    )
    return errors.groupBy("source_type", "source", "error").agg(F.count("*").alias("n"))


def landed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole scrape: feed files, a registry file and listings are landed and read, articles go through the raw table.

    One service is switched off, a part of the listings has bad dates, and the look-back
    holds for every source. Errors are listed beside the articles.
    """
    root = work_dir(spark, "landed")
    views.land_feeds(spark, sf_dir, f"{root}/feeds")
    views.land_registry(spark, sf_dir, f"{root}/sources")
    landed = {
        "rss": feeds.read_landed(spark, f"{root}/feeds"),
        "nvd": views.with_bad_dates(_cves(spark, sf_dir), 5),
        "arxiv": views.with_bad_dates(_papers(spark, sf_dir), 5),
    }
    sources, errors = daily.scrape(registry.read_registry(spark, f"{root}/sources"), landed, AS_OF)
    tables.write_raw(tables.union_sources(sources), f"{root}/raw", AS_OF[:10])
    raw = tables.read_raw(spark, f"{root}/raw", AS_OF[:10]).select(
        "source_type", "source", "id", "title", "content", iso_millis(F.col("published_at")).alias("published"), F.lit(None).cast("string").alias("error")
    )
    counted = errors.groupBy("source_type", "source", "error").agg(F.count("*").cast("string").alias("content"))
    return raw.unionByName(counted, allowMissingColumns=True)


def bad_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of unreadable dates: listings and records give errors, feeds take the scrape time, reports show the text."""
    wrong = F.when(F.pmod("doc_pos", F.lit(3)) == 0, F.regexp_replace("body", r", \d+ Jan 2024", ", soon"))
    odd = _feeds(spark, sf_dir).withColumn("body", F.coalesce(wrong, F.col("body")))
    kept = feeds.normalize_feeds(views.with_bad_dates(odd, 5)).select(
        F.lit("rss").alias("source_type"), F.col("title").alias("item"), display_date(iso_millis(F.col("published_at"))).alias("shown")
    )
    listed = cves.cve_errors(views.with_bad_dates(_cves(spark, sf_dir), 5)).unionByName(
        papers.paper_errors(views.with_bad_dates(_papers(spark, sf_dir), 5))
    )
    return kept.unionByName(listed.select("source_type", F.lit("error").alias("item"), display_date(F.col("error")).alias("shown")))


def source_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.source_stats(dedup_first(views.articles(spark, sf_dir)), landing_errors(spark, sf_dir))


def source_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = stats.error_pages(materialize(landing_errors(spark, sf_dir), "errors"))
    return pages.select("source_type", "page", F.array_join("errors", "|").alias("errors"))


def seen_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seen.seen_windows(sent(spark, sf_dir))


def unseen_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    unique = dedup_first(views.articles(spark, sf_dir), ["id", "run_date"])
    return seen.unseen_by_date(unique, sent(spark, sf_dir)).select("id", "run_date", "pos")


def seen_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seen.seen_backfill(appearances(spark, sf_dir).filter("included"))


def backfill_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = daily.backfill_digests(rated(spark, sf_dir), AS_OF, ["id", "title"])
    return pages.select(
        "digest_date", "page", "total_scraped", "total_included",
        F.array_join(F.transform("articles", lambda a: a["title"]), ",").alias("articles"),
    )


def retention_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = views.articles(spark, sf_dir)
    parts = {"raw": articles, "processed": views.analyzed_of(articles), "digests": included(spark, sf_dir), "sent_ids": sent(spark, sf_dir)}
    return retention.expired_partitions(parts, LATE_REPORT_DATE)


def retention_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``retention_expired`` of stored tables, from their folders and footers."""
    root = work_dir(spark, "retention")
    parts = {"raw": views.articles(spark, sf_dir), "processed": views.analyzed(spark, sf_dir),
             "digests": included(spark, sf_dir), "sent_ids": sent(spark, sf_dir)}
    for dataset, df in parts.items():
        date = retention.DATE_COLUMNS[dataset]
        df.select("id", date).write.partitionBy(date).parquet(f"{root}/{dataset}")
    return retention.expired_stored(spark, {dataset: f"{root}/{dataset}" for dataset in parts}, LATE_REPORT_DATE)


def unseen_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``unseen_articles`` against a table of sent ids that is dealt out by id once."""
    unique = dedup_first(views.articles(spark, sf_dir), ["id", "run_date"])
    store = seen.BucketedSent(work_dir(spark, "sent-buckets"), buckets=16)
    store.append(sent(spark, sf_dir))
    return seen.unseen_by_date(unique, store.open(spark)).select("id", "run_date", "pos")


def stored_seen_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the look-back before a date, read from a stored table of which one day was rewritten as empty."""
    root = work_dir(spark, "sent")
    ids = materialize(sent(spark, sf_dir), "sent-ids")
    for day in STORED_DAYS:
        seen.save_sent(ids.filter(F.col("sent_date") == day), root, day)
    seen.save_sent(ids.limit(0), root, STORED_DAYS[-1])
    return seen.seen_window(seen.read_sent(spark, root), "2024-01-11", lookback=5)


def make_length_scorer() -> triage.ReplyFunction:
    """A stand-in for a model: the summary tells the length of the prompt."""
    reply = '{{"summary": "{}", "severity": "HIGH", "relevance_category": "OTHER", "relevance_score": {}, "reasoning": "length"}}'
    return lambda prompts: [reply.format(len(p), len(p) % 100) for p in prompts]


def score_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = triage.triage(views.articles(spark, sf_dir), make_length_scorer)
    return done.select("pos", "triage_status", "summary", "severity", F.col("relevance.score").alias("score"))


def build_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage.build_prompts(views.articles(spark, sf_dir)).select("pos", "prompt")


def parsed_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated articles, stored once, with replies of which some come twice."""
    unique = materialize(dedup_first(views.articles(spark, sf_dir)), "unique")
    replies = views.responses(unique)
    again = replies.filter(F.col("response_text").isNotNull()).withColumn("response_text", F.lit("~ a later reply"))
    return triage.triage(unique, replies.unionByName(again))


def parse_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_replies(spark, sf_dir).select(
        "id", "pos", "triage_status", "summary", "severity",
        F.col("relevance.category").alias("category"), F.col("relevance.score").alias("score"),
        F.col("relevance.reasoning").alias("reasoning"),
        F.array_join("affected_products", ",").alias("products"),
    )


def rule_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = papers.normalize_papers(_papers(spark, sf_dir))
    return triage.triage(listed, "rules").select(
        "id", "severity", F.col("relevance.category").alias("category"), F.col("relevance.score").alias("score")
    )


def error_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _naive(metrics.error_alarms(views.metrics(spark, sf_dir)))


def hourly_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _naive(metrics.hourly_status(views.metrics(spark, sf_dir)))


def hourly_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _naive(metrics.hourly_errors(views.metrics(spark, sf_dir)))


def hourly_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    p95 = metrics.hourly_p95(views.metrics(spark, sf_dir))
    return _naive(p95.withColumn("p95", F.round("p95", 6)))


def p95_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact 95th percentile of one group that holds all metrics, at most 200 of them sorted in one task."""
    p95 = selected_quantile(views.metrics(spark, sf_dir), [], "duration", 0.95, "p95", most=200)
    return p95.select(F.round("p95", 6).alias("p95"))


def sketched_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and months from stored hourly sketches: their sizes, and whether the exact ranks of the estimates are near enough."""
    durations = views.metrics(spark, sf_dir).filter(F.col("duration").isNotNull() & ~F.isnan("duration"))
    hours = materialize(sketches.hourly_sketches(durations), "sketches")
    error = 2 * sketches.rank_error()  # twice what holds for 99 of 100 sketches
    found = []
    for period in ("day", "month"):
        estimated = sketches.estimates(sketches.merged(hours, period, "fn"), 0.95, "p95")
        own = durations.select(F.date_trunc(period, "ts").alias("period_start"), "fn", "duration").join(estimated, ["period_start", "fn"])
        ranks = own.groupBy("period_start", "fn").agg(
            F.max("n").alias("n"), F.count_if(F.col("duration") < F.col("p95")).alias("below"),
            F.count_if(F.col("duration") <= F.col("p95")).alias("upto"),
        )
        near = (F.col("below") <= F.col("n") * (0.95 + error) + 1) & (F.col("upto") >= F.col("n") * (0.95 - error) - 1)
        found.append(ranks.select(F.lit(period).alias("period"), F.to_date("period_start").alias("day"), "fn", "n", near.alias("near")))
    return found[0].unionByName(found[1])


def rate_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    alarm = metrics.rate_alarm(views.metrics(spark, sf_dir))
    return _naive(alarm.withColumn("bounce_rate", F.round("bounce_rate", 9)))


def daily_sends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _naive(metrics.daily_sends(views.metrics(spark, sf_dir)))


def budget_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = metrics.budget_alerts(views.metrics(spark, sf_dir))
    return alerts.select("day", F.col("month_to_date").cast("double").alias("month_to_date"), "alert_percent")


def _naive(df: DataFrame) -> DataFrame:
    """Window starts as time without zone, the way the oracle returns them."""
    return df.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def land_and_run(
    landings: list[DataFrame], label: str, step: Step, schema: str,
    remember: Callable[[DataFrame], DataFrame] | None = None, **memory,
) -> DataFrame:
    """Land tables one after the other and run the stream over each; with ``remember``, by a memory."""
    spark = landings[0].sparkSession
    root = work_dir(spark, label)
    known = Memory(f"{root}/memory", **memory) if remember else None
    for landing in landings:
        landing.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(landing.schema).parquet(f"{root}/in")
        write_batches(stream, f"{root}/out", f"{root}/checkpoint", step, schema, known, remember)
    return read_batches(spark, f"{root}/out", schema).drop("batch_id")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First arrivals over three landings of the articles."""
    articles = tables.article_columns(views.articles(spark, sf_dir))
    landings = [articles.filter(F.pmod("pos", F.lit(3)) == i) for i in (2, 0, 1)]
    return land_and_run(landings, "dedup", ingest.first_arrivals, schemas.ARTICLE).select("id", "pos")


def stream_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sends over three landings, ten days each."""
    chosen = materialize(included(spark, sf_dir).select("id", "run_date"), "appearances")
    landings = [chosen.filter(F.floor((F.dayofmonth("run_date") - 1) / 10) == i) for i in range(3)]
    return land_and_run(landings, "seen", seen_stream.send_batch, seen_stream.OUTPUT)


def stream_dedup_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First arrivals within five days, over six landings in order of scraping, with a memory of five days."""
    articles = tables.article_columns(views.articles(spark, sf_dir)).withColumn("scraped_at", F.col("published_at"))
    landings = [articles.filter(F.floor((F.dayofmonth("scraped_at") - 1) / 5) == i) for i in range(6)]
    found = land_and_run(
        landings, "dedup-days", lambda batch, known: ingest.remembered_arrivals(batch, known, days=5), schemas.ARTICLE,
        ingest.arrival_times, keep_days=5, every=2,
    )
    return found.select("id", "pos")


def stream_seen_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stream_seen`` over six landings, with a memory of nine days."""
    chosen = materialize(included(spark, sf_dir).select("id", "run_date"), "appearances")
    landings = [chosen.filter(F.floor((F.dayofmonth("run_date") - 1) / 5) == i) for i in range(6)]
    return land_and_run(
        landings, "seen-days", lambda batch, known: seen_stream.send_remembered(batch, known, keep_days=9), seen_stream.OUTPUT,
        seen_stream.send_dates, time="date", keep_days=9, every=2,
    )


def late_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triage of articles and replies that land side by side in three parts; replies take up to 36 hours, 24 are waited for."""
    unique = materialize(dedup_first(views.articles(spark, sf_dir)).withColumn("arrived_at", F.col("published_at")), "unique")
    delay = F.make_dt_interval(hours=(F.pmod("pos", F.lit(5)) * 9).cast("int"))
    answers = unique.select("id", views.reply_of(F.col("pos")).alias("response_text"), (F.col("arrived_at") + delay).alias("replied_at"), "pos")
    answers = answers.filter("response_text IS NOT NULL")
    again = answers.filter(F.pmod("pos", F.lit(3)) == 0).withColumns(
        {"response_text": F.lit("~ a later reply"), "replied_at": F.col("replied_at") + F.make_dt_interval(hours=F.lit(1))}
    )
    answers = materialize(answers.unionByName(again).drop("pos"), "answers")
    root = work_dir(spark, "replies")
    # The last landing brings a row to either stream from later on, which ends the wait of all others.
    later = F.lit("2024-03-01 00:00:00").cast("timestamp")
    for part in range(4):
        for df, time, name in ((unique, "arrived_at", "asked"), (answers, "replied_at", "answered")):
            third = F.least(F.lit(2), F.floor(F.date_diff(F.to_date(time), F.lit("2024-01-01").cast("date")) / 10))
            if part < 3:
                landing = df.filter(third == part)
            else:
                beat = {"id": F.lit("later"), time: later}
                landing = spark.range(1).select(*(beat.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in df.schema.fields))
            landing.write.mode("append").parquet(f"{root}/{name}")
        asked = spark.readStream.schema(unique.schema).parquet(f"{root}/asked")
        answered = spark.readStream.schema(answers.schema).parquet(f"{root}/answered")
        waited = reply_stream.await_replies(asked, answered)
        write_available(waited, f"{root}/out", f"{root}/checkpoint")
    stored = spark.read.schema(waited.schema).parquet(f"{root}/out").filter("id <> 'later'").drop("arrived_at")
    return reply_stream.triaged(stored).select(
        "id", "pos", "triage_status", "summary", "severity",
        F.col("relevance.category").alias("category"), F.col("relevance.score").alias("score"),
    )


def stream_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = views.metrics_of(views.stream(spark, sf_dir, "events"))
    alerts = drain(budget.budget_stream(landed), "budget")
    return alerts.select("day", F.col("month_to_date").cast("double").alias("month_to_date"), "alert_percent")


def stream_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = views.metrics_of(views.stream(spark, sf_dir, "events"))
    return _naive(drain(alarms.error_alarm_stream(landed), "alarms"))


def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alarms of three landings, of which a tenth of the rows comes one landing late, and the signals that were too late."""
    events = views.table(spark, sf_dir, "events")
    part = F.least(F.lit(2), F.floor((F.dayofmonth("ts") - 1) / 10) + (F.pmod("user_id", F.lit(10)) == 0).cast("int"))
    root = work_dir(spark, "late")
    for i in range(3):
        events.filter(part == i).write.mode("append").parquet(f"{root}/in")
        landed = spark.readStream.schema(events.schema).parquet(f"{root}/in")
        late.write_alarms(views.metrics_of(landed), root, f"{root}/checkpoint")
    listed = late.read_late(spark, root).groupBy("window_start", "alarm").agg(F.count("*").alias("n"))
    kinds = [df.select(F.lit(kind).alias("kind"), "window_start", "alarm", "n")
             for kind, df in (("alarm", late.read_alarms(spark, root)), ("late", listed))]
    return _naive(kinds[0].unionByName(kinds[1]))


def stream_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = views.metrics_of(views.stream(spark, sf_dir, "events"))
    return _naive(drain(alarms.hourly_p95_stream(landed), "p95"))


REGISTERED: dict[str, Query] = {
    "source_registry": source_registry,
    "enabled_articles": enabled_articles,
    "feed_normalize": feed_normalize,
    "arxiv_normalize": arxiv_normalize,
    "paper_topics": paper_topics,
    "cve_normalize": cve_normalize,
    "cve_recent_severe": cve_recent_severe,
    "union_sources": union_sources,
    "json_round_trip": json_round_trip,
    "strip_html": strip_html_pages,
    "article_ids": article_ids,
    "normalize_urls": normalize_urls,
    "lookback_recent": lookback_recent,
    "policy_filter": policy_filter,
    "rank_articles": rank_articles,
    "rank_small_blocks": rank_small_blocks,
    "digest_daily": digest_daily,
    "digest_small_pages": digest_small_pages,
    "digest_counts": digest_counts,
    "severity_counts": severity_counts,
    "digest_subjects": digest_subjects,
    "render_text": render_text,
    "render_html": render_html,
    "render_small_pages": render_small_pages,
    "dedup_first": dedup_query,
    "run_funnel": run_funnel,
    "run_counts": run_counts,
    "scrape_errors": scrape_errors,
    "landed_run": landed_run,
    "bad_dates": bad_dates,
    "source_stats": source_stats,
    "source_errors": source_errors,
    "seen_window": seen_window,
    "stored_seen_window": stored_seen_window,
    "unseen_articles": unseen_articles,
    "unseen_bucketed": unseen_bucketed,
    "seen_backfill": seen_backfill,
    "backfill_digests": backfill_digests,
    "retention_expired": retention_expired,
    "retention_stored": retention_stored,
    "build_prompts": build_prompts,
    "parse_triage": parse_triage,
    "rule_triage": rule_triage,
    "score_hook": score_hook,
    "error_alarms": error_alarms,
    "hourly_status": hourly_status,
    "hourly_errors": hourly_errors,
    "hourly_p95": hourly_p95,
    "p95_of_all": p95_of_all,
    "sketched_p95": sketched_p95,
    "rate_alarm": rate_alarm,
    "daily_sends": daily_sends,
    "budget_alerts": budget_alerts,
    "stream_dedup": stream_dedup,
    "stream_seen": stream_seen,
    "stream_dedup_days": stream_dedup_days,
    "stream_seen_days": stream_seen_days,
    "late_replies": late_replies,
    "stream_budget": stream_budget,
    "stream_alarms": stream_alarms,
    "stream_late": stream_late,
    "stream_p95": stream_p95,
}


def _configured(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _configured(query) for name, query in REGISTERED.items()}
