"""Replies that come later than their articles: two streams joined within a time limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsmill.operators.triage import parse_replies

#: How long an article waits for its reply, and how late rows of either stream may come.
WAIT = "24 hours"
LATENESS = "1 hour"


def await_replies(articles: DataFrame, replies: DataFrame, wait: str = WAIT, lateness: str = LATENESS) -> DataFrame:
    """Articles with the replies that come within ``wait`` of them, or without one.

    ``articles`` has an ``id`` and ``arrived_at``, ``replies`` ``(id, response_text,
    replied_at)``; both are streams. A pair is emitted when both of its rows are there;
    an article that is still alone once both watermarks have passed its limit is emitted
    with a NULL reply. State holds the rows of the last ``wait`` only. Rows behind
    their stream's watermark are dropped by Spark. Rows without an id never match, and
    Spark removes such replies before they can advance the watermark.
    """
    asked = articles.withWatermark("arrived_at", lateness)
    answered = replies.select(F.col("id").alias("reply_id"), "response_text", "replied_at").withWatermark("replied_at", lateness)
    limit = F.expr(f"arrived_at + interval {wait}")
    match = (F.col("id") == F.col("reply_id")) & F.col("replied_at").between(F.col("arrived_at"), limit)
    return asked.join(answered, match, "left_outer").drop("reply_id")


def triaged(waited: DataFrame, key: str = "id") -> DataFrame:
    """Triage of what ``await_replies`` has stored, one row per article.

    Of several replies to an article the first counts, of those at one time the text that
    sorts first. Articles without a reply have the status ``missing``: the quarantine.
    """
    order = Window.partitionBy(key).orderBy(F.col("replied_at").asc_nulls_last(), "response_text")
    first = waited.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").drop("_nth", "replied_at")
    return parse_replies(first)


def quarantine(triage: DataFrame) -> DataFrame:
    """Articles whose reply never came."""
    return triage.filter(F.col("triage_status") == "missing")
