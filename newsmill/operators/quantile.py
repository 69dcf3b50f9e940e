"""Exact quantiles of groups of any size.

``exact_quantile`` brackets once, which suits many groups; ``selected_quantile`` brackets
again and again until what is left of every group fits into one task, however large it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmill.session import materialize

ACCURACY = 10_000
MARGIN = 10 / ACCURACY


def exact_quantile(df: DataFrame, by: Sequence[str], value: str, q: float, name: str) -> DataFrame:
    """Linearly interpolated quantile, as ``percentile`` gives it.

    ``percentile`` keeps every distinct value of a group in one buffer. Here a
    sketch of fixed size brackets the quantile first (its rank error is a
    tenth of the bracket's margin); values below the bracket are only counted,
    those above are dropped, and the distinct ones inside, a two-thousandth of
    the group or so, are sorted. NaN counts as the largest value, as it does for
    ``percentile``. Groups of all sizes go the same way; a bracket that missed
    would raise.
    """
    rows = df.filter(F.col(value).isNotNull())
    probs = [max(q - MARGIN, 0.0), min(q + MARGIN, 1.0)]
    place = F.lit(q) * (F.col("_total") - 1)
    stats = (
        rows.groupBy(*by)
        .agg(
            F.count("*").alias("_total"),
            F.percentile_approx(value, probs, ACCURACY).alias("_bracket"),
        )
        .select(
            *by,
            F.floor(place).alias("_k0"),
            F.ceil(place).alias("_k1"),
            (place - F.floor(place)).alias("_fraction"),
            F.col("_bracket")[0].alias("_low"),
            F.col("_bracket")[1].alias("_high"),
        )
    )
    v = F.col(value)
    side = F.when(v < F.col("_low"), -1).when(v > F.col("_high"), 1).otherwise(0)
    counted = (
        rows.join(stats, list(by))
        .withColumn("_side", side)
        .groupBy(*by, "_k0", "_k1", "_fraction", "_side", F.when(F.col("_side") == 0, v).alias("_v"))
        .agg(F.count("*").alias("_n"), F.min(v).alias("_least"), F.max(v).alias("_most"))
    )
    running = Window.partitionBy(*by).orderBy("_side", "_v").rowsBetween(Window.unboundedPreceding, 0)
    counted = counted.withColumn("_upto", F.sum("_n").over(running))

    def at(k: str) -> Column:
        """The value at a place: inside the bracket, or next to it on either side."""
        before = F.col("_upto") - F.col("_n")
        inside = (F.col("_side") == 0) & F.col(k).between(before, F.col("_upto") - 1)
        below = (F.col("_side") == -1) & (F.col(k) == F.col("_upto") - 1)
        above = (F.col("_side") == 1) & (F.col(k) == before)
        return F.min(F.when(inside, F.col("_v")).when(below, F.col("_most")).when(above, F.col("_least")))

    found = counted.groupBy(*by).agg(F.first("_fraction").alias("_fraction"), at("_k0").alias("_v0"), at("_k1").alias("_v1"))
    ok = F.col("_v0").isNotNull() & F.col("_v1").isNotNull()
    result = F.col("_v0") + (F.col("_v1") - F.col("_v0")) * F.col("_fraction")
    return found.select(*by, F.when(ok, result).otherwise(F.raise_error(F.lit("quantile bracket missed"))).alias(name))


#: Values that a round's sketch gives of each group, evenly by rank.
SPLITS = 256
#: Values of a group that may be sorted in one task.
SORTED = 100_000
#: A round leaves a hundredth of a group, so this is never met.
MAX_ROUNDS = 30


def selected_quantile(df: DataFrame, by: Sequence[str], value: str, q: float, name: str, most: int = SORTED) -> DataFrame:
    """``exact_quantile`` by selection, one row per group: no task sorts more than ``most`` values of a group.

    A round takes two values around the wanted rank from a sketch of fixed size and counts
    what lies below, at, between and above them. The rank is then in one of these parts, so
    only that one goes on, a hundredth of the group; a value that repeats very often is a
    part by itself and ends the search. Counts decide, so a sketch that is off costs a
    round and no result. NULLs do not count, NaN is the largest value; a group without
    values gives no row. Only the largest size left comes to the driver.
    """
    keys = list(by) or ["_all"]
    rows = df.withColumn("_all", F.lit(0)).select(*keys, F.col(value).alias("_v")).filter("_v IS NOT NULL")
    place = F.lit(q) * (F.count("*") - 1)
    sizes = rows.groupBy(*keys).agg(F.floor(place).alias("_k"), (place - F.floor(place)).alias("_fraction"), F.count("*").alias("_n"))
    places = materialize(sizes, "quantile-places")
    left, inside, values = places.select(*keys, "_k", "_n"), rows, []
    for _ in range(MAX_ROUNDS):
        if (left.agg(F.max("_n")).first()[0] or 0) <= most:
            break
        left, inside, found = _narrowed(inside, left, keys)
        values.append(found)
    else:
        raise RuntimeError("quantile did not settle")
    nth = Window.partitionBy(*keys).orderBy("_v")
    sorted_out = inside.join(left, keys).withColumn("_nth", F.row_number().over(nth) - 1).filter("_nth = _k").select(*keys, "_v")
    for found in values:
        sorted_out = sorted_out.unionByName(found)
    lower = materialize(sorted_out.withColumnRenamed("_v", "_v0"), "quantile-values")
    return _interpolated(rows, places, lower, keys, name).select(*by, name)


def _narrowed(inside: DataFrame, left: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One round: ranks and sizes of the groups that go on, their values, and the values of those that are done."""
    probs = [i / SPLITS for i in range(SPLITS + 1)]
    splits = inside.groupBy(*by).agg(F.percentile_approx("_v", probs, ACCURACY).alias("_splits"))
    at = F.floor(F.col("_k") * SPLITS / F.col("_n")).cast("int")
    brackets = left.join(splits, by).select(
        *by, "_k",
        F.when(at > 0, F.get("_splits", at - 1)).alias("_low"),
        F.when(at + 2 <= SPLITS, F.get("_splits", at + 2)).alias("_high"),
    )
    brackets = materialize(brackets, "quantile-brackets")
    below, above = (F.coalesce(c, F.lit(False)) for c in (F.col("_v") < F.col("_low"), F.col("_v") > F.col("_high")))
    part = F.when(below, 0).when(above, 4).when(F.col("_v").eqNullSafe(F.col("_low")), 1).when(F.col("_v").eqNullSafe(F.col("_high")), 3).otherwise(2)
    parted = inside.join(brackets.select(*by, "_low", "_high"), by).select(*by, "_v", part.alias("_part"))
    counts = parted.groupBy(*by).agg(*(F.count_if(F.col("_part") == i).alias(f"_c{i}") for i in range(5)))
    before = [sum((F.col(f"_c{j}") for j in range(i)), F.lit(0).cast("long")) for i in range(6)]
    chosen = F.coalesce(*(F.when(F.col("_k") < before[i + 1], i) for i in range(5)))
    decided = brackets.join(counts, by).withColumn("_part", chosen).select(
        *by, "_part",
        (F.col("_k") - F.element_at(F.array(*before), F.col("_part") + 1)).alias("_k"),
        F.element_at(F.array(*(F.col(f"_c{i}") for i in range(5))), F.col("_part") + 1).alias("_n"),
        F.when(F.col("_part") == 1, F.col("_low")).when(F.col("_part") == 3, F.col("_high")).alias("_v"),
    )
    decided = materialize(decided, "quantile-parts")
    on = decided.filter(~F.col("_part").isin(1, 3))
    rest = materialize(parted.join(on.select(*by, "_part"), [*by, "_part"]).select(*by, "_v"), "quantile-inside")
    return on.select(*by, "_k", "_n"), rest, decided.filter(F.col("_part").isin(1, 3)).select(*by, "_v")


def _interpolated(rows: DataFrame, places: DataFrame, lower: DataFrame, by: list[str], name: str) -> DataFrame:
    """The quantile from the value at its lower rank: the next rank has the same value, or the next larger one."""
    v, v0 = F.col("_v"), F.col("_v0")
    next_up = rows.join(lower, by).groupBy(*by).agg(
        F.first("_v0").alias("_v0"), F.count_if(v <= v0).alias("_upto"), F.min(F.when(v > v0, v)).alias("_next")
    )
    upper = F.when(F.col("_upto") > F.col("_k") + 1, v0).otherwise(F.coalesce("_next", v0))
    value = F.when(F.col("_fraction") > 0, v0 + (upper - v0) * F.col("_fraction")).otherwise(v0)
    return places.join(next_up, by).select(*by, value.alias(name))
