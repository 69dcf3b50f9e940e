"""First-wins deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsmill.functions.text import ordinal


def dedup_first(df: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Keep the row of each key that comes first in input order.

    Spark pushes the limit on ``row_number`` below the shuffle, so each task
    sends at most one row per key however many copies there are.
    """
    first = Window.partitionBy(*keys).orderBy(ordinal())
    return df.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")
