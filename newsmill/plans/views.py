"""Article, feed and metric views derived from the given tables.

Each view is a projection of one table: it neither drops rows nor shuffles,
so its size is that of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.functions.text import escape_markup
from newsmill.operators.policy import CATEGORY_NAMES, SEVERITY_NAMES
from newsmill.schemas import SOURCE_TYPES
from newsmill.session import materialize

SCRAPED_AT = "2024-02-01 06:00:00"
FUNCTIONS = ("RssScraper", "NvdScraper", "ArxivScraper", "XScraper", "Processor", "Filter", "Notifier")
PAPER_CLASSES = ("cs.CR", "cs.AI", "cs.LG", "cs.DB")
PAPER_TOPICS = ("Adversarial", "Security", "Prompt injection", "Databases", "LLM", "Storage")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents_to_parse(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Documents as they are scanned; where ``partitions`` is given and a scan has fewer tasks, dealt out to so many.

    Parsing costs far more than moving the text, and a table of one row group is one task.
    A table that is scanned in enough tasks is never shuffled.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    if partitions is None or docs.rdd.getNumPartitions() >= partitions:
        return docs
    return docs.repartition(partitions)


def pick(values: tuple[str, ...], index: Column) -> Column:
    """``values[index % len(values)]``."""
    return F.get(F.array(*map(F.lit, values)), F.pmod(index, F.lit(len(values))).cast("int"))


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _published(number: Column) -> Column:
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    hours = F.pmod(number, F.lit(30)) * 24 + F.pmod(number, F.lit(24))
    return F.timestamp_add("HOUR", hours.cast("int"), start)


def articles_of(documents: DataFrame) -> DataFrame:
    """Articles of a (batch or streaming) documents frame."""
    doc = F.col("doc_id")
    kind = F.pmod(doc, F.lit(4)).cast("int")
    return documents.select(
        F.sha2("text", 256).alias("id"),
        F.concat(F.lit("Report "), _text("doc_id"), F.lit(" from "), "source", F.lit(" in "), "lang").alias("title"),
        F.concat(F.lit("https://example.com/"), "source", F.lit("/"), _text("doc_id")).alias("url"),
        "source",
        pick(SOURCE_TYPES, doc).alias("source_type"),
        F.col("text").alias("content"),
        _published(doc).alias("published_at"),
        F.lit(SCRAPED_AT).cast("timestamp").alias("scraped_at"),
        kind.alias("source_ord"),
        doc.alias("pos"),
        _published(doc).cast("date").alias("run_date"),
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles_of(table(spark, sf_dir, "documents"))


def analyzed_of(raw: DataFrame) -> DataFrame:
    """Articles with a triage result made from their position."""
    pos = F.col("pos")
    products = F.when(pos % 3 == 0, F.array().cast("array<string>")).when(pos % 3 == 1, F.array("source"))
    return raw.select(
        "*",
        F.concat(F.lit("Summary of report "), _text("pos")).alias("summary"),
        pick(SEVERITY_NAMES, pos).alias("severity"),
        pick(CATEGORY_NAMES, F.floor(pos / 5)).alias("category"),
        F.pmod(pos * 37, F.lit(101)).cast("int").alias("score"),
        products.otherwise(F.array("source", "source_type")).alias("affected_products"),
        F.col("run_date").alias("digest_date"),
    )


def analyzed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyzed_of(articles(spark, sf_dir))


def reply_of(pos: Column) -> Column:
    """Reply text of an article: well-formed, fenced, damaged, or none (NULL)."""
    number = pos.cast("string")
    score = F.when(pos % 17 == 0, F.concat(F.lit('"'), number, F.lit('"')))
    score = score.when(pos % 41 == 0, "85.5").when(pos % 43 == 0, "150").when(pos % 47 == 0, "-10")
    severity = F.when(pos % 13 == 0, "EXTREME").otherwise(pick(SEVERITY_NAMES, pos))
    base = F.concat(
        F.lit('{"summary": "Reply on report '), number, F.lit('", "severity": "'), severity,
        F.lit('", "relevance_category": "'), pick(CATEGORY_NAMES, F.floor(pos / 5)),
        F.lit('", "relevance_score": '), score.otherwise((pos * 37 % 101).cast("string")),
        F.lit(', "reasoning": "rated '), number, F.lit('", "affected_products": '),
        F.when(pos % 23 == 0, '["Alpha", 42, null, "Beta"]').when(pos % 5 == 0, "[]").otherwise('["Gamma"]'),
        F.lit("}"),
    )
    return (
        F.when(pos % 29 == 0, F.lit(None))
        .when(pos % 11 == 0, F.concat(F.lit("No rating for report "), number))
        .when(pos % 31 == 0, "[1]")
        .when(pos % 37 == 0, "null")
        .when(pos % 19 == 0, F.concat(base, F.lit(" and that is all")))
        .when(pos % 7 == 0, F.concat(F.lit("```json\n"), base, F.lit("\n```")))
        .otherwise(base)
    )


def responses(unique_articles: DataFrame) -> DataFrame:
    """Replies to deduplicated articles, one per id."""
    return unique_articles.select("id", reply_of(F.col("pos")).alias("response_text"))


def _lines() -> Column:
    """The text of a document, line by line; nothing is cut."""
    return F.split(F.regexp_replace("text", r"[\x00-\x08\x0B\x0C\x0E-\x1F]", " "), "\n")


def _rfc822(ts: Column) -> Column:
    return F.date_format(ts, "EEE, d MMM yyyy HH:mm:ss' GMT'")


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def feeds(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """One feed per document, one item per line: RSS and Atom in turn."""
    doc, when = _text("doc_id"), _published(F.col("doc_id"))

    def link(i: Column) -> Column:
        return F.concat(F.lit("https://example.com/"), "source", F.lit("/"), doc, F.lit("/"), i.cast("string"))

    def html(line: Column) -> Column:
        return escape_markup(F.concat(F.lit("<p>"), line, F.lit("</p>")))

    def rss_item(line: Column, i: Column) -> Column:
        return F.concat(
            F.lit("<item><title>Item "), doc, F.lit("-"), i.cast("string"), F.lit("</title><link>"), link(i),
            F.lit("</link><description>"), html(line), F.lit("</description><pubDate>"), _rfc822(when),
            F.lit("</pubDate></item>"),
        )

    def atom_entry(line: Column, i: Column) -> Column:
        return F.concat(
            F.lit('<entry><title type="html">Item '), doc, F.lit("-"), i.cast("string"),
            F.lit('</title><link rel="related" href="https://example.com/x"/><link rel="alternate" href="'), link(i),
            F.lit('"/><summary type="html">'), html(line), F.lit("</summary><updated>"), _iso(when),
            F.lit("</updated></entry>"),
        )

    rss = F.concat(
        F.lit('<?xml version="1.0"?><rss version="2.0"><channel><title>Feed</title>'),
        F.array_join(F.transform(_lines(), rss_item), ""),
        F.lit("</channel></rss>"),
    )
    atom = F.concat(
        F.lit('<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>Feed</title>'),
        F.array_join(F.transform(_lines(), atom_entry), ""),
        F.lit("</feed>"),
    )
    return documents_to_parse(spark, sf_dir, partitions).select(
        F.col("source").alias("source_name"),
        F.when(F.col("doc_id") % 2 == 0, rss).otherwise(atom).alias("body"),
        F.lit(SCRAPED_AT).cast("timestamp").alias("scraped_at"),
        F.col("doc_id").alias("doc_pos"),
    )


def papers(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """One paper listing per document, one entry per line."""
    doc = F.col("doc_id")

    def entry(line: Column, i: Column) -> Column:
        key = doc + i
        return F.concat(
            F.lit("<entry><id>http://arxiv.org/abs/"), _text(doc), F.lit("."), i.cast("string"), F.lit("v"),
            _text(key % 3 + 1), F.lit("</id><title>"), pick(PAPER_TOPICS, key), F.lit("\n  study "), _text(doc),
            F.lit("-"), i.cast("string"), F.lit("</title><summary>"), escape_markup(line),
            F.lit("</summary><published>"), _iso(_published(key)), F.lit('</published><category term="'),
            pick(PAPER_CLASSES, key), F.lit('"/></entry>'),
        )

    body = F.concat(
        F.lit('<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom">'),
        F.array_join(F.transform(_lines(), entry), ""),
        F.lit("</feed>"),
    )
    return documents_to_parse(spark, sf_dir, partitions).select(
        body.alias("body"), F.lit(SCRAPED_AT).cast("timestamp").alias("scraped_at"), doc.alias("doc_pos")
    )


def cves(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """One vulnerability page per document, one record per line."""
    doc = F.col("doc_id")

    def record(line: Column, i: Column) -> Column:
        key = doc + i
        score = (key % 101) / 10
        severity = (
            F.when(score >= 9, "CRITICAL").when(score >= 7, "HIGH").when(score >= 4, "MEDIUM").otherwise("LOW")
        )
        metric = F.struct(F.struct(score.alias("baseScore"), severity.alias("baseSeverity")).alias("cvssData"))
        older = F.struct(F.struct(F.lit(5.0).alias("baseScore"), F.lit("MEDIUM").alias("baseSeverity")).alias("cvssData"))
        none = F.filter(F.array(metric), lambda m: F.lit(False))
        kind = key % 4
        v31 = F.when(kind.isin(0, 3), F.array(metric)).when(kind == 1, none)
        v30 = F.when(kind == 1, F.array(metric)).when(kind == 3, F.array(older))
        return F.struct(
            F.struct(
                F.concat(F.lit("CVE-"), _text(doc), F.lit("-"), i.cast("string")).alias("id"),
                F.date_format(_published(key), "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("published"),
                F.when(key % 7 == 0, "Rejected").otherwise("Analyzed").alias("vulnStatus"),
                F.array(
                    F.struct(F.lit("es").alias("lang"), F.lit("otra").alias("value")),
                    F.struct(F.lit("en").alias("lang"), line.alias("value")),
                ).alias("descriptions"),
                F.struct(v31.alias("cvssMetricV31"), v30.alias("cvssMetricV30")).alias("metrics"),
            ).alias("cve")
        )

    page = F.struct(
        F.size(_lines()).alias("totalResults"),
        F.lit(0).alias("startIndex"),
        F.size(_lines()).alias("resultsPerPage"),
        F.transform(_lines(), record).alias("vulnerabilities"),
    )
    return documents_to_parse(spark, sf_dir, partitions).select(
        F.to_json(page).alias("body"), F.lit(SCRAPED_AT).cast("timestamp").alias("scraped_at"), doc.alias("doc_pos")
    )


#: Bytes of the documents whose items are landed as one feed file, about.
FILE_BYTES = 1 << 19


def land_feeds(spark: SparkSession, sf_dir: str, path: str) -> None:
    """RSS files of each source, of about ``FILE_BYTES`` of documents each; the lines of a document are its items.

    The number of files follows the size of a source, and not the numbers its documents have.
    """
    doc, when = _text("doc_id"), _published(F.col("doc_id"))

    def item(line: Column, i: Column) -> Column:
        place = F.concat(F.lit("https://example.com/"), "source", F.lit("/"), doc, F.lit("/"), i.cast("string"))
        return F.concat(
            F.lit("<item><title>Item "), doc, F.lit("-"), i.cast("string"), F.lit("</title><link>"), place,
            F.lit("</link><description>"), escape_markup(line), F.lit("</description><pubDate>"), _rfc822(when), F.lit("</pubDate></item>"),
        )

    documents = table(spark, sf_dir, "documents")
    # A document counts a byte more, so that bytes bound the items of a file too.
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1)
    files = documents.groupBy(F.col("source").alias("of")).agg(F.greatest(F.lit(1), F.ceil(size / FILE_BYTES)).alias("files"))
    files = materialize(files, "feed-files")
    docs = documents.join(files, F.col("source").eqNullSafe(F.col("of"))).select(
        "source", F.pmod(F.xxhash64("doc_id"), "files").alias("block"), "doc_id", F.array_join(F.transform(_lines(), item), "").alias("items")
    )
    files = docs.groupBy("source", "block").agg(F.sort_array(F.collect_list(F.struct("doc_id", "items"))).alias("docs"))
    body = F.concat(
        F.lit('<?xml version="1.0"?><rss version="2.0"><channel><title>Feed</title>'),
        F.array_join(F.col("docs.items"), ""), F.lit("</channel></rss>"),
    )
    landed = files.select(F.col("source").alias("source_name"), body.alias("body"))
    landed.write.option("maxRecordsPerFile", 1).partitionBy("source_name").text(path)


def land_registry(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A registry file: every source as a feed, switched on by its amount of text; one service on, one off."""
    amounts = table(spark, sf_dir, "documents").groupBy("source").agg(F.sum("n_chars").alias("amount"))
    entry = F.struct(
        F.col("source").alias("name"), F.concat(F.lit("https://example.com/"), "source").alias("url"), (F.col("amount") % 3 > 0).alias("enabled")
    )
    listed = amounts.agg(F.sort_array(F.collect_list(entry)).alias("rss"))
    services = F.from_json(
        F.lit('[{"name": "Papers", "type": "arxiv", "enabled": true}, {"name": "Records", "type": "nvd", "enabled": false}]'),
        "array<struct<name: string, type: string, enabled: boolean>>",
    )
    listed.select(F.to_json(F.struct("rss", services.alias("apis")))).coalesce(1).write.text(path)


def with_bad_dates(landed: DataFrame, every: int) -> DataFrame:
    """Documents of which every so many have months that do not exist."""
    body = F.when(F.pmod("doc_pos", F.lit(every)) == 0, F.replace(F.col("body"), F.lit("2024-01-"), F.lit("2024-17-")))
    return landed.withColumn("body", F.coalesce(body, F.col("body")))


def registries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One registry per source, with switches made from its amount of text."""

    def feed(suffix: str, enabled: Column) -> Column:
        name = F.concat("source", F.lit(suffix))
        url = F.concat(F.lit("https://example.com/"), name)
        return F.struct(name.alias("name"), url.alias("url"), enabled.alias("enabled"))

    def service(name: str, kind: str, enabled: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), F.lit(kind).alias("type"), enabled.alias("enabled"))

    amount = F.col("amount")
    per_source = table(spark, sf_dir, "documents").groupBy("source").agg(F.sum("n_chars").alias("amount"))
    return per_source.select(
        F.col("source").alias("registry"),
        F.array(feed("", amount % 2 == 0), feed("-archive", amount % 3 == 0)).alias("rss"),
        F.when(
            amount % 5 > 0,
            F.array(
                service("First", "nvd", amount % 2 == 0),
                service("Second", "nvd", amount % 2 == 1),
                service("Third", "arxiv", amount % 3 > 0),
            ),
        )
        .otherwise(F.array(service("Third", "arxiv", amount % 3 > 0)))
        .alias("apis"),
    )


def metrics_of(events: DataFrame) -> DataFrame:
    """Metrics of a (batch or streaming) events frame."""
    kind = F.col("event_type")
    status = F.when(kind == "purchase", "succeeded").when(kind == "error", "failed").when(kind == "signup", "timed_out")
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        pick(FUNCTIONS, F.col("user_id")).alias("fn"),
        status.alias("status"),
        (kind == "error").alias("is_error"),
        F.col("value").alias("duration"),
        (kind == "view").cast("int").alias("sends"),
        (kind == "click").cast("int").alias("bounces"),
        (F.col("value").cast("decimal(18,2)") / 1000).cast("decimal(18,6)").alias("cost"),
    )


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics_of(table(spark, sf_dir, "events"))


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a file stream; as a pattern, the path may be a file or a folder."""
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{{{name}.parquet}}")
