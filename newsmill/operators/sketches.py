"""Percentiles that merge: KLL sketches per hour, folded into longer periods without a rescan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmill.operators.metrics import hour_start

#: Size parameter of the sketches; a sketch keeps about three times as many values.
K = 1000


def rank_error(k: int = K) -> float:
    """The part of the ranks by which an estimate may be off, with a confidence of 99 per cent (published fit for KLL)."""
    return 2.296 / k**0.9723


def hourly_sketches(metrics: DataFrame, k: int = K) -> DataFrame:
    """One sketch of the durations per hour and function, to be stored; durations that are NULL or NaN do not count."""
    counted = metrics.filter(F.col("duration").isNotNull() & ~F.isnan("duration"))
    sketch = F.kll_sketch_agg_double("duration", F.lit(k)).alias("sketch")
    return counted.groupBy(hour_start().alias("window_start"), "fn").agg(sketch)


def merged(sketches: DataFrame, period: str, *by: str, k: int = K) -> DataFrame:
    """Stored sketches folded into days, months or other calendar ``period``s, as ``(period_start, *by, sketch)``."""
    start = F.date_trunc(period, "window_start").alias("period_start")
    return sketches.groupBy(start, *by).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def estimates(sketches: DataFrame, q: float, name: str, k: int = K) -> DataFrame:
    """``sketches`` with the number of values ``n``, the quantile ``name``, and values ``low`` and ``high`` around it.

    The exact quantile lies between ``low`` and ``high`` with a confidence of 99 per cent.
    """
    error = rank_error(k)

    def at(rank: float):
        return F.kll_sketch_get_quantile_double("sketch", F.lit(min(max(rank, 0.0), 1.0)))

    return sketches.select(
        *(c for c in sketches.columns if c != "sketch"),
        F.kll_sketch_get_n_double("sketch").alias("n"),
        at(q).alias(name), at(q - error).alias("low"), at(q + error).alias("high"),
    )
