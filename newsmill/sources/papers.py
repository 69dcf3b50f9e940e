"""Paper listings (Atom) to articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.functions.dates import parse_iso
from newsmill.functions.text import article_id, collapse_whitespace, item_pos, paper_url
from newsmill.sources.feeds import XML_OPTIONS, root_element

PAPER_DOC = """
    entry array<struct<
        id: string, title: string, summary: string, published: string, updated: string,
        category: array<struct<_term: string>>>>,
    _corrupt_record string
"""

# Subject classes and title terms of the topic query.
TOPIC_CATEGORIES = ("cs.CR", "cs.AI", "cs.LG")
TOPIC_TERMS = (
    "adversarial", "security", "attack", "vulnerability", "jailbreak", "backdoor",
    "poisoning", "llm", "large language model", "prompt injection", "ai safety",
)
TOPIC_LIMIT = 100


def _listing() -> Column:
    return F.from_xml(F.when(root_element(F.col("body")) == "feed", F.col("body")), PAPER_DOC, XML_OPTIONS)


def _entries(landed: DataFrame) -> DataFrame:
    doc = _listing()
    # Exploding the parsed array itself would make Spark parse each document
    # again, for a filter on the array's size that it infers.
    entries = F.transform(
        "_doc.entry",
        lambda e: F.struct(
            e["id"].alias("id"),
            e["title"].alias("title"),
            e["summary"].alias("summary"),
            F.coalesce(e["published"], e["updated"]).alias("date"),
            e["category"].alias("category"),
        ),
    )
    items = landed.withColumn("_doc", doc).select("scraped_at", "doc_pos", F.posexplode(entries).alias("_i", "e"))
    date = F.col("e.date")
    published = F.when(date.isNull(), F.col("scraped_at")).otherwise(parse_iso(date))
    return (
        items.withColumn("url", paper_url(F.coalesce("e.id", F.lit(""))))
        .filter("url <> ''")
        .select(
            article_id(F.col("url")).alias("id"),
            collapse_whitespace(F.coalesce("e.title", F.lit(""))).alias("title"),
            "url",
            F.lit("ArXiv").alias("source"),
            F.lit("arxiv").alias("source_type"),
            collapse_whitespace(F.coalesce("e.summary", F.lit(""))).alias("content"),
            published.alias("published_at"),
            "scraped_at",
            F.lit(2).alias("source_ord"),
            item_pos(F.col("doc_pos"), F.col("_i")).alias("pos"),
            F.transform("e.category", lambda c: c["_term"]).alias("categories"),
            date.alias("_date"),
        )
    )


def normalize_papers(landed: DataFrame) -> DataFrame:
    """One article per entry with an id; ``categories`` is kept beside it.

    An entry whose date cannot be read is left out here and listed by
    ``paper_errors``; the other entries of its document are kept.
    """
    return _entries(landed).filter("published_at IS NOT NULL").drop("_date")


def paper_errors(landed: DataFrame) -> DataFrame:
    """Listings that could not be read, and entries without a readable date; each document is parsed once."""
    reason = F.when(F.col("body").isNull() | (F.trim("body") == ""), "empty document")
    reason = reason.when(F.col("_doc").isNull(), "not a listing").when(F.col("_doc._corrupt_record").isNotNull(), "malformed XML")
    dated = F.transform(
        "_doc.entry",
        lambda e: F.struct(paper_url(F.coalesce(e["id"], F.lit(""))).alias("url"), F.coalesce(e["published"], e["updated"]).alias("date")),
    )
    bad = F.filter(dated, lambda e: (e["url"] != "") & e["date"].isNotNull() & parse_iso(e["date"]).isNull())
    listed = F.transform(bad, lambda e: F.concat(F.lit("ArXiv: invalid date "), e["date"], F.lit(" in "), e["url"]))
    errors = F.concat(F.array_compact(F.array(F.concat(F.lit("ArXiv: "), reason))), F.coalesce(listed, F.array().cast("array<string>")))
    return landed.withColumn("_doc", _listing()).select(
        F.lit("arxiv").alias("source_type"), F.lit("ArXiv").alias("source"), F.explode(errors).alias("error")
    )


def on_topic(title: Column, categories: Column) -> Column:
    """Subject class listed, and a topic term in the title as whole words."""
    words = "|".join(TOPIC_TERMS)
    named = F.lower(title).rlike(rf"(?:^|[^a-z0-9])(?:{words})(?:[^a-z0-9]|$)")
    return F.arrays_overlap(categories, F.array(*map(F.lit, TOPIC_CATEGORIES))) & named


def newest_on_topic(papers: DataFrame, limit: int = TOPIC_LIMIT) -> DataFrame:
    """The newest papers on topic: a top-k, not a full sort."""
    chosen = papers.filter(on_topic(F.col("title"), F.col("categories")))
    return chosen.orderBy(F.desc("published_at"), "id").limit(limit)
