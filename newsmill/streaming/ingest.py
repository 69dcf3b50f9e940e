"""Streaming ingest with deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmill import schemas
from newsmill.functions.dates import recent
from newsmill.operators.dedup import dedup_first
from newsmill.sources import registry
from newsmill.sources.feeds import from_registry, normalize_feeds
from newsmill.streaming.runs import write_batches


def first_arrivals(batch: DataFrame, earlier: DataFrame, days: int | None = None) -> DataFrame:
    """Articles of a batch whose id has not arrived before, the first copy of each.

    No date that a feed supplies decides: nothing is dropped for being old or
    ahead. ``days`` limits what counts as before to copies scraped at most so
    many days earlier; by default every earlier one counts.
    """
    first = dedup_first(batch).alias("a")
    seen = earlier.select("id", "scraped_at").alias("s")
    match = F.col("a.id") == F.col("s.id")
    if days is not None:
        match = match & (F.col("s.scraped_at") >= F.col("a.scraped_at") - F.make_dt_interval(F.lit(days)))
    return first.join(seen, match, "left_anti")


def remembered_arrivals(batch: DataFrame, known: DataFrame, days: int) -> DataFrame:
    """``first_arrivals`` by what a ``Memory`` holds of earlier ones: only the days that can matter are read."""
    oldest = batch.agg(F.min("scraped_at").alias("at")).first().at
    if oldest is not None:
        known = known.filter(F.col("day") >= F.date_sub(F.to_date(F.lit(oldest)), days))
    return first_arrivals(batch, known.select("id", F.col("at").alias("scraped_at")), days)


def arrival_times(results: DataFrame) -> DataFrame:
    """What a ``Memory`` keeps of stored arrivals."""
    return results.select("id", F.col("scraped_at").alias("at"))


def ingest_stream(articles: DataFrame, path: str, checkpoint: str, days: int | None = None) -> None:
    """Store the first arrival of every id among the articles that have landed."""
    write_batches(articles, path, checkpoint, lambda batch, earlier: first_arrivals(batch, earlier, days), schemas.ARTICLE)


def feed_articles(landed: DataFrame, config: DataFrame, as_of: str | None = None, hours: float = 26) -> DataFrame:
    """Articles of landed documents of the feeds that are switched on.

    With ``as_of`` only those of the look-back before it. The normaliser keeps
    no state, so it serves batches and streams alike.
    """
    articles = normalize_feeds(from_registry(landed, registry.enabled_rss(config)))
    return articles if as_of is None else articles.filter(recent(F.col("published_at"), as_of, hours=hours))
