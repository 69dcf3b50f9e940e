"""RSS 2.0 and Atom documents to articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsmill.functions.dates import parse_lenient
from newsmill.functions.text import article_id, item_pos, strip_html, trim_unicode

RSS_DOC = """
    channel struct<item: array<struct<
        title: string, link: string, description: string, pubDate: string, `content:encoded`: string>>>,
    _corrupt_record string
"""
ATOM_DOC = """
    entry array<struct<
        id: string, title: string,
        link: array<struct<_href: string, _rel: string, _type: string>>,
        summary: string, content: string, published: string, updated: string>>,
    _corrupt_record string
"""
#: Files that one source may have in a run.
FILES = 1 << 20
XML_OPTIONS = {"columnNameOfCorruptRecord": "_corrupt_record", "mode": "PERMISSIVE"}


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed documents: files below ``path/<source name>/``, one body each.

    The folder may also be a partition, ``source_name=<source name>``. The scrape time is the file's modification time. ``from_registry`` numbers
    the documents by their registry entry and file name.
    """
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    parent = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return files.select(
        F.url_decode(F.regexp_replace(parent, r"\Asource_name=", "")).alias("source_name"),
        F.col("value").alias("body"),
        F.col("_metadata.file_modification_time").alias("scraped_at"),
        F.col("_metadata.file_path").alias("file"),
    )


def from_registry(landed: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents of the given registry entries, numbered by (registry entry, file).

    The first entry of a name counts. Only file names are numbered, not bodies.
    No size is assumed for the registry: Spark broadcasts it when the measured
    size allows, and splits a hot source otherwise.
    """
    entries = sources.groupBy(F.col("name").alias("source_name")).agg(F.min("registry_pos").cast("bigint").alias("_entry"))
    by_file = Window.partitionBy("source_name").orderBy("file")
    files = landed.select("source_name", "file").distinct().withColumn("_number", F.row_number().over(by_file) - 1)
    fits = F.when(F.col("_number") < FILES, F.col("_entry") * FILES + F.col("_number"))
    numbered = files.join(entries, "source_name").select(
        "source_name", "file",
        F.coalesce(fits, F.raise_error(F.lit("too many files of one source")).cast("bigint")).alias("doc_pos"),
    )
    return landed.select("source_name", "body", "scraped_at", "file").join(numbered, ["source_name", "file"]).drop("file")


def root_element(body: Column) -> Column:
    """Name of the first element of an XML document."""
    skip = r"(?s)\A(?:[\s\x{FEFF}]++|<\?.*?\?>|<!--.*?-->|<![A-Z][^>]*+>)*+"
    return F.regexp_extract(body, skip + r"<([A-Za-z_][\w:.-]*+)", 1)


def _atom_href(links: Column) -> Column:
    """Address of the first link that is the entry's own, even when empty."""
    own = F.filter(links, lambda x: F.coalesce(x["_rel"], F.lit("")).isin("", "alternate"))
    return F.get(own, F.lit(0))["_href"]


def _parsed(landed: DataFrame) -> DataFrame:
    kinds = landed.withColumn("_root", root_element(F.col("body")))
    return kinds.withColumns(
        {
            "_rss": F.from_xml(F.when(F.col("_root") == "rss", F.col("body")), RSS_DOC, XML_OPTIONS),
            "_atom": F.from_xml(F.when(F.col("_root") == "feed", F.col("body")), ATOM_DOC, XML_OPTIONS),
        }
    )


def normalize_feeds(landed: DataFrame) -> DataFrame:
    """One article per RSS item or Atom entry; other documents give none.

    Both shapes are read in one pass over ``landed``. A date that is missing
    or unreadable becomes the scrape time, so the article stays recent.
    """
    from_rss = F.transform(
        "_rss.channel.item",
        lambda i: F.struct(
            i["link"].alias("link"),
            i["title"].alias("title"),
            F.coalesce(i["content:encoded"], i["description"]).alias("content"),
            i["pubDate"].alias("date"),
        ),
    )
    from_atom = F.transform(
        "_atom.entry",
        lambda e: F.struct(
            _atom_href(e["link"]).alias("link"),
            e["title"].alias("title"),
            F.coalesce(e["content"], e["summary"]).alias("content"),
            F.coalesce(e["published"], e["updated"]).alias("date"),
        ),
    )
    items = _parsed(landed).select(
        "source_name", "scraped_at", "doc_pos", F.posexplode(F.coalesce(from_rss, from_atom)).alias("_i", "_item")
    )
    url = trim_unicode(F.coalesce("_item.link", F.lit("")))
    return (
        items.withColumn("url", url)
        .filter("url <> ''")
        .select(
            article_id(F.col("url")).alias("id"),
            strip_html(F.coalesce("_item.title", F.lit(""))).alias("title"),
            "url",
            F.col("source_name").alias("source"),
            F.lit("rss").alias("source_type"),
            strip_html(F.coalesce("_item.content", F.lit(""))).alias("content"),
            parse_lenient(F.col("_item.date"), F.col("scraped_at")).alias("published_at"),
            "scraped_at",
            F.lit(0).alias("source_ord"),
            item_pos(F.col("doc_pos"), F.col("_i")).alias("pos"),
        )
    )


def feed_errors(landed: DataFrame) -> DataFrame:
    """Documents that could not be read, as (source_type, source, error)."""
    broken = F.coalesce("_rss._corrupt_record", "_atom._corrupt_record").isNotNull()
    reason = (
        F.when(F.col("body").isNull() | (F.trim("body") == ""), "empty document")
        .when(F.col("_root") == "", "not an XML document")
        .when(broken, "malformed XML")
    )
    return (
        _parsed(landed)
        .withColumn("_reason", reason)
        .filter("_reason IS NOT NULL")
        .select(
            F.lit("rss").alias("source_type"),
            F.col("source_name").alias("source"),
            F.concat("source_name", F.lit(": "), "_reason").alias("error"),
        )
    )
