"""Run statistics: the funnel of a day, and rows and errors per source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmill.functions.text import ordinal
from newsmill.operators.ranking import PAGE_SIZE, collect_pages, rank_in_groups
from newsmill.operators.seen import send_decisions


def run_funnel(rated: DataFrame) -> DataFrame:
    """raw, unique, unseen, included and excluded articles per run date.

    ``rated`` holds every raw appearance with ``run_date`` and ``included``;
    of several copies on one date the first in input order counts. ``excluded``
    is what reached the policy and failed; ``already_sent`` what did not reach it.
    """
    first = F.min_by("included", ordinal())
    daily = rated.groupBy("id", "run_date").agg(F.count("*").alias("copies"), first.alias("included"))
    decided = send_decisions(daily, carry=["copies"])
    return decided.groupBy("run_date").agg(
        F.sum("copies").alias("raw"),
        F.count("*").alias("unique"),
        F.count_if(~F.col("seen")).alias("unseen"),
        F.count_if("sent").alias("included"),
        F.count_if(~F.col("seen") & ~F.col("sent")).alias("excluded"),
        F.count_if("seen").alias("already_sent"),
    )


def source_stats(articles: DataFrame, errors: DataFrame, by: Sequence[str] = ("source_type",)) -> DataFrame:
    """Articles and errors per source type, also for sources with only one of them."""
    ok = articles.groupBy(*by).agg(F.count("*").alias("article_count"))
    bad = errors.groupBy(*by).agg(F.count("*").alias("error_count"))
    both = ok.join(bad, list(by), "full_outer")
    return both.na.fill(0, ["article_count", "error_count"])


def error_pages(errors: DataFrame, by: Sequence[str] = ("source_type",), page_size: int = PAGE_SIZE) -> DataFrame:
    """Error texts per source type as ordered arrays of bounded length.

    ``pos`` is the unique position of an error in its group.
    """
    ranked = rank_in_groups(errors, by, [], F.col("pos"))
    return collect_pages(ranked, by, F.col("error"), page_size=page_size, name="errors")
