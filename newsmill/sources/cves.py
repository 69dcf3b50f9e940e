"""Vulnerability records (JSON pages) to articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.functions.dates import as_of_window, parse_iso
from newsmill.functions.text import article_id, item_pos

_METRIC = "array<struct<cvssData: struct<baseScore: double, baseSeverity: string>>>"
CVE_PAGE = f"""
    totalResults bigint, startIndex bigint, resultsPerPage bigint,
    vulnerabilities array<struct<cve: struct<
        id: string, published: string, lastModified: string, vulnStatus: string,
        descriptions: array<struct<lang: string, value: string>>,
        references: array<struct<url: string>>,
        metrics: struct<cvssMetricV31: {_METRIC}, cvssMetricV30: {_METRIC}>>>>,
    _corrupt_record string
"""
JSON_OPTIONS = {"columnNameOfCorruptRecord": "_corrupt_record", "mode": "PERMISSIVE"}

DETAIL_URL = "https://nvd.nist.gov/vuln/detail/"
SEVERE = ("HIGH", "CRITICAL")


def _cvss(metrics: Column) -> Column:
    """First v3.1 score, else first v3.0 score; empty arrays count as missing."""
    v31 = F.get(metrics["cvssMetricV31"], F.lit(0))
    v30 = F.get(metrics["cvssMetricV30"], F.lit(0))
    return F.coalesce(v31, v30)["cvssData"]


def _shortest(number: Column) -> Column:
    """A double without a trailing ``.0``."""
    return F.regexp_replace(number.cast("string"), r"\.0\z", "")


def _records(landed: DataFrame) -> DataFrame:
    page = landed.withColumn("_page", F.from_json("body", CVE_PAGE, JSON_OPTIONS))
    # Exploding the parsed array itself would make Spark parse each page again,
    # for a filter on the array's size that it infers.
    records = F.transform("_page.vulnerabilities", lambda v: v["cve"])
    rows = page.select("scraped_at", "doc_pos", F.posexplode(records).alias("_i", "_v"))
    rows = rows.select("scraped_at", "doc_pos", "_i", "_v.*").withColumn("_cvss", _cvss(F.col("metrics")))
    english = F.get(F.filter("descriptions", lambda d: d["lang"] == "en"), F.lit(0))["value"]
    text = F.coalesce(english, F.lit(""))
    level = F.coalesce(F.concat(F.lit(" ("), "_cvss.baseSeverity", F.lit(")")), F.lit(""))
    prefix = F.concat(F.lit("CVSS "), _shortest(F.col("_cvss.baseScore")), level, F.lit(". "))
    url = F.concat(F.lit(DETAIL_URL), F.col("id"))
    return rows.select(
        article_id(url).alias("id"),
        F.col("id").alias("title"),
        url.alias("url"),
        F.lit("NVD").alias("source"),
        F.lit("nvd").alias("source_type"),
        F.concat(F.coalesce(prefix, F.lit("")), text).alias("content"),
        parse_iso(F.col("published")).alias("published_at"),
        "scraped_at",
        F.lit(1).alias("source_ord"),
        item_pos(F.col("doc_pos"), F.col("_i")).alias("pos"),
        F.col("_cvss.baseSeverity").alias("base_severity"),
        F.coalesce(F.col("vulnStatus") == "Rejected", F.lit(False)).alias("rejected"),
        F.col("published").alias("_date"),
    )


def normalize_cves(landed: DataFrame) -> DataFrame:
    """One article per record; times without a zone are UTC.

    ``base_severity`` and ``rejected`` are kept for ``recent_severe``. Records
    without a readable date are listed by ``cve_errors`` instead.
    """
    return _records(landed).filter("published_at IS NOT NULL").drop("_date")


def cve_errors(landed: DataFrame) -> DataFrame:
    """Pages that could not be read, or not wholly, and records without a readable date; each page is parsed once."""
    whole = F.coalesce(F.col("_page.vulnerabilities").isNotNull() & F.col("_page._corrupt_record").isNull(), F.lit(False))
    page = F.when(~whole, F.array(F.lit("NVD: unreadable page"))).otherwise(F.array().cast("array<string>"))
    bad = F.filter("_page.vulnerabilities", lambda v: parse_iso(v["cve"]["published"]).isNull())
    shown = F.transform(
        bad, lambda v: F.concat(F.lit("NVD: invalid date "), F.coalesce(v["cve"]["published"], F.lit("(none)")), F.lit(" in "), v["cve"]["id"])
    )
    errors = F.concat(page, F.coalesce(F.array_compact(shown), F.array().cast("array<string>")))
    return landed.withColumn("_page", F.from_json("body", CVE_PAGE, JSON_OPTIONS)).select(
        F.lit("nvd").alias("source_type"), F.lit("NVD").alias("source"), F.explode(errors).alias("error")
    )


def recent_severe(cves: DataFrame, as_of: str, hours: float = 48) -> DataFrame:
    """HIGH and CRITICAL records published in the window and not rejected."""
    start, end = as_of_window(as_of, hours)
    return cves.filter(
        F.col("base_severity").isin(*SEVERE) & F.col("published_at").between(start, end) & ~F.col("rejected")
    )
