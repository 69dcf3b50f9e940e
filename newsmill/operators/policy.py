"""Policy tables, and the predicate that decides what a digest includes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Severity, rank, colour.
SEVERITIES = (
    ("CRITICAL", 5, "#dc2626"),
    ("HIGH", 4, "#ea580c"),
    ("MEDIUM", 3, "#d97706"),
    ("LOW", 2, "#2563eb"),
    ("INFO", 1, "#6b7280"),
)

# Category, label, colour, lowest severity rank, lowest score.
CATEGORIES = (
    ("BEDROCK_AGENTCORE", "BEDROCK", "#7c3aed", 1, 0),
    ("AI_GENERAL", "AI", "#0891b2", 3, 30),
    ("AWS_SECURITY", "AWS", "#059669", 4, 50),
    ("OTHER", "OTHER", "#6b7280", 5, 0),
)

SEVERITY_NAMES = tuple(row[0] for row in SEVERITIES)
CATEGORY_NAMES = tuple(row[0] for row in CATEGORIES)


def _literal(value: Any) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(int(value))


def constant_table(spark: SparkSession, names: Sequence[str], rows: Iterable[Sequence[Any]]) -> DataFrame:
    """A table of text and integer literals; its size is constant and known."""
    values = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


def severity_dim(spark: SparkSession) -> DataFrame:
    return constant_table(spark, ["severity", "severity_rank", "severity_color"], SEVERITIES)


def category_dim(spark: SparkSession, rules: Iterable[Sequence[Any]] = CATEGORIES) -> DataFrame:
    names = ["category", "category_label", "category_color", "min_rank", "min_score"]
    return constant_table(spark, names, rules)


def with_policy(df: DataFrame, rules: Iterable[Sequence[Any]] = CATEGORIES) -> DataFrame:
    """Look up rank, labels, colours and thresholds, and add ``included``.

    The two sides are literal tables of five and four rows, so broadcasting
    them is safe at any input size. Unknown values are never included.
    """
    spark = df.sparkSession
    return (
        df.join(F.broadcast(severity_dim(spark)), "severity", "left")
        .join(F.broadcast(category_dim(spark, rules)), "category", "left")
        .withColumn(
            "included",
            F.coalesce(
                (F.col("severity_rank") >= F.col("min_rank")) & (F.col("score") >= F.col("min_score")),
                F.lit(False),
            ),
        )
    )


def policy_filter(df: DataFrame, rules: Iterable[Sequence[Any]] = CATEGORIES) -> DataFrame:
    return with_policy(df, rules).filter("included")


def include_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Included and excluded rows per group; unknown values count as excluded."""
    return with_policy(df).groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if("included").alias("included"),
        F.count_if(~F.col("included")).alias("excluded"),
    )
