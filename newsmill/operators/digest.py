"""Ranking, digest records and rendered reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.functions.text import escape_markup, ordinal
from newsmill.operators.policy import SEVERITIES, with_policy
from newsmill.operators.ranking import BLOCK_BITS, PAGE_SIZE, collect_pages, rank_in_groups

TITLE = "Daily Intelligence Digest"
FOOTER = ("Assembled automatically once a day",)


def rank_articles(included: DataFrame, by: Sequence[str] = ("digest_date",), block_bits: int = BLOCK_BITS) -> DataFrame:
    """Rank by severity, then score, then input order.

    Needs ``severity_rank`` and ``score``, which ``with_policy`` provides.
    """
    return rank_in_groups(included, by, [-F.col("severity_rank"), -F.col("score")], ordinal(), block_bits=block_bits)


def severity_counts(included: DataFrame, by: Sequence[str] = ("digest_date",)) -> DataFrame:
    """Rows per group and severity; severities that do not occur have no row."""
    return included.groupBy(*by, "severity", "severity_rank").agg(F.count("*").alias("n"))


def digest_totals(rated: DataFrame) -> DataFrame:
    """One row per digest date: totals, and counts per severity in rank order.

    ``rated`` is the output of ``with_policy`` over the unseen articles, so a
    date on which nothing was included still has a row.
    """
    each = [
        F.struct(
            F.lit(name).alias("severity"),
            F.lit(color).alias("color"),
            F.count_if(F.col("included") & (F.col("severity") == name)).alias("n"),
        )
        for name, _, color in SEVERITIES
    ]
    return rated.groupBy("digest_date").agg(
        F.count("*").alias("total_scraped"),
        F.count_if("included").alias("total_included"),
        F.filter(F.array(*each), lambda c: c["n"] > 0).alias("severities"),
    )


@dataclass(frozen=True)
class Digest:
    """What reports are made from: totals per date, and ranked articles."""

    totals: DataFrame
    ranked: DataFrame


def prepare(rated: DataFrame, dates: DataFrame | None = None) -> Digest:
    """Totals and ranking of rated articles.

    ``dates`` (a table of digest_date) adds dates without any article. Store
    both frames when several reports are made from them.
    """
    totals = digest_totals(rated)
    if dates is not None:
        none = F.array().cast(totals.schema["severities"].dataType)
        totals = dates.join(totals, "digest_date", "left").na.fill(0, ["total_scraped", "total_included"])
        totals = totals.withColumn("severities", F.coalesce("severities", none))
    return Digest(totals, rank_articles(rated.filter("included")))


def _paged(source: Digest, item: Column, page_size: int) -> DataFrame:
    """Pages of ``item`` with the totals of their date; empty dates included.

    Totals have a row for each page, so that pages meet them by date and page: the
    pages of a date are never in one task.
    """
    items = source.ranked.select("digest_date", "rank", item.alias("_item"))
    pages = collect_pages(items, ["digest_date"], F.col("_item"), page_size=page_size)
    none = F.array().cast(pages.schema["items"].dataType)
    last = F.greatest(F.lit(0), F.ceil(F.col("total_included") / page_size) - 1).cast("bigint")
    totals = source.totals.withColumn("last_page", last)
    totals = totals.withColumn("page", F.explode(F.sequence(F.lit(0).cast("bigint"), "last_page")))
    paged = totals.join(pages, ["digest_date", "page"], "left").filter(F.col("items").isNotNull() | (F.col("page") == 0))
    return paged.withColumn("items", F.coalesce("items", none))


def digest_pages(
    source: Digest, generated_at: str, fields: Sequence[str], page_size: int = PAGE_SIZE
) -> DataFrame:
    """Digest records: totals of a date and its ranked articles.

    A date with more than ``page_size`` articles continues on further pages
    (0 to ``last_page``); all of them together are the digest.
    """
    return _paged(source, F.struct(*fields), page_size).select(
        "digest_date",
        "page",
        "last_page",
        F.lit(generated_at).cast("timestamp").alias("generated_at"),
        "total_scraped",
        "total_included",
        F.col("items").alias("articles"),
    )


def subject(title: str = TITLE) -> Column:
    noun = F.when(F.col("total_included") == 1, "item").otherwise("items")
    return F.concat(F.lit(f"{title} — "), F.col("digest_date").cast("string"),
                    F.lit(" ("), F.col("total_included").cast("string"), F.lit(" "), noun, F.lit(")"))


def digest_subjects(totals: DataFrame, title: str = TITLE) -> DataFrame:
    return totals.select("digest_date", subject(title).alias("subject"))


def _part(head: Column, items: Column, foot: Column) -> Column:
    """Text of one page; the pages of a date concatenate to the whole body."""
    return F.concat(
        F.when(F.col("page") == 0, head).otherwise(""),
        items,
        F.when(F.col("page") == F.col("last_page"), foot).otherwise(""),
    )


def _published() -> Column:
    return F.coalesce(F.date_format("published_at", "MMM d, yyyy"), F.lit(""))


def render_text(
    source: Digest, title: str = TITLE, footer: Sequence[str] = FOOTER, page_size: int = PAGE_SIZE
) -> DataFrame:
    """Plain-text body per date, as (digest_date, page, last_page, body)."""
    lines = F.concat_ws(
        "\n",
        F.concat(F.lit("["), "severity", F.lit("] ["), "category_label", F.lit("] "), "title"),
        "summary",
        F.when(F.size("affected_products") > 0, F.concat(F.lit("Affected: "), F.array_join("affected_products", ", "))),
        F.concat(F.lit("Source: "), "source", F.lit(" — "), "url"),
        F.concat(F.lit("Published: "), _published()),
        F.lit(""),
    )
    counts = F.concat(F.col("total_included").cast("string"), F.lit(" items included / "),
                      F.col("total_scraped").cast("string"), F.lit(" scraped"))
    bar = F.lit("=" * 60)
    head = F.concat_ws(
        "\n", bar, F.concat(F.lit(f"{title.upper()} — "), F.col("digest_date").cast("string")), counts, bar, F.lit("")
    )
    foot = F.lit("\n".join(["", "-" * 60, title, *footer]))
    items = F.array_join(F.transform("items", lambda x: F.concat(F.lit("\n"), x)), "")
    paged = _paged(source, lines, page_size)
    return paged.select("digest_date", "page", "last_page", _part(head, items, foot).alias("body"))


def _badge(text: Column, color: Column) -> Column:
    return F.concat(F.lit('<b style="color:#fff;padding:2px 6px;background:'), color, F.lit('">'), text, F.lit("</b>"))


ROW_SEPARATOR = "<tr><td><hr></td></tr>"


def render_html(
    source: Digest, title: str = TITLE, footer: Sequence[str] = FOOTER, page_size: int = PAGE_SIZE
) -> DataFrame:
    """HTML body per date, as (digest_date, page, last_page, body).

    Values are escaped: cleaned article text may contain markup characters.
    """

    def value(name: str) -> Column:
        return escape_markup(F.coalesce(F.col(name), F.lit("")))

    products = escape_markup(F.array_join("affected_products", ", "))
    row = F.concat(
        F.lit('<tr><td style="border-left:4px solid '), "severity_color", F.lit('">'),
        _badge(F.col("severity"), F.col("severity_color")), F.lit(" "),
        _badge(F.col("category_label"), F.col("category_color")),
        F.lit('<h3><a href="'), value("url"), F.lit('">'), value("title"), F.lit("</a></h3><p>"),
        value("summary"), F.lit("</p>"),
        F.when(F.size("affected_products") > 0, F.concat(F.lit("<p>Affected: "), products, F.lit("</p>"))).otherwise(""),
        F.lit("<p>"), value("source"), F.lit(" · "), _published(), F.lit("</p></td></tr>"),
    )
    name = title.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    date = F.col("digest_date").cast("string")
    badges = F.array_join(
        F.transform("severities", lambda s: F.concat(_badge(s["severity"], s["color"]), F.lit(" "), s["n"].cast("string"))),
        " ",
    )
    head = F.concat(
        F.lit('<!DOCTYPE html>\n<html lang="en"><head><meta charset="UTF-8"><title>'),
        F.lit(f"{name} — "), date, F.lit(f"</title></head>\n<body><h1>{name}</h1>\n<p>"),
        date, F.lit(" · "), F.col("total_included").cast("string"), F.lit(" included · "),
        F.col("total_scraped").cast("string"), F.lit(" scraped</p>\n<p>"), badges, F.lit("</p>\n<table>"),
    )
    foot = F.lit("</table>\n<footer>" + "<br>".join([name, *footer]) + "</footer></body></html>")
    rows = F.array_join("items", ROW_SEPARATOR)
    rows = F.when(F.col("page") > 0, F.concat(F.lit(ROW_SEPARATOR), rows)).otherwise(rows)
    paged = _paged(source, row, page_size)
    return paged.select("digest_date", "page", "last_page", _part(head, rows, foot).alias("body"))


def rate(unseen_articles: DataFrame) -> DataFrame:
    """Analysed articles, flattened and with policy columns, ready for a digest."""
    flat = unseen_articles.withColumns(
        {"category": F.col("relevance.category"), "score": F.col("relevance.score")}
    )
    return with_policy(flat)
