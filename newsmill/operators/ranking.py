"""Exact ranks inside groups of any size, and fixed-size pages of ranked rows.

A plain ``row_number()`` per group sends the whole group to one task. Here rows
are counted per sort key and block of input positions, the counts (not the
rows) are summed up in order, and only the place inside a block needs the rows.
Input positions are unique, so a block holds at most ``2 ** block_bits`` rows.
Blocks are summed up inside coarse blocks of ``2 ** block_bits`` blocks, and
coarse blocks inside the group; a task there sees one count per sort key and
coarse block of a group, which is few as long as sort keys have few values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

BLOCK_BITS = 20
PAGE_SIZE = 500


def rank_in_groups(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    ordinal: Column,
    name: str = "rank",
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Add the 1-based rank of each row in its group.

    ``order`` holds numeric sort keys with few values each (descending ones
    are passed negated); ``ordinal`` is the unique input position that breaks
    ties. Rows with a NULL key are left out. The input is read twice, first
    only its keys, so it should be a table or a projection of one.
    """
    groups = [f"_g{i}" for i in range(len(group))]
    keys = [f"_k{i}" for i in range(len(order))]
    rows = df.withColumns({**dict(zip(keys, order)), "_ordinal": ordinal})
    rows = rows.na.drop(subset=[*group, *keys, "_ordinal"])
    # Keys that cannot be NULL: joins then add no filter of their own, both
    # uses of the counts have one plan, and Spark computes them once.
    never_null = {g: F.coalesce(F.col(c).cast("string"), F.lit("")) for g, c in zip(groups, group)}
    never_null |= {k: F.coalesce(k, F.lit(0)) for k in keys}
    never_null["_block"] = F.coalesce(F.shiftright("_ordinal", block_bits), F.lit(0))
    rows = rows.withColumns(never_null)

    coarse = F.shiftright("_block", block_bits).alias("_coarse")
    blocks = rows.groupBy(*groups, *keys, "_block").agg(F.count("*").alias("_n")).select("*", coarse)
    in_coarse = Window.partitionBy(*groups, *keys, "_coarse").orderBy("_block")
    in_group = Window.partitionBy(*groups).orderBy(*keys, "_coarse")
    coarse_starts = (
        blocks.groupBy(*groups, *keys, "_coarse")
        .agg(F.sum("_n").alias("_n"))
        .withColumn("_coarse_start", _sum_before(in_group))
        .drop("_n")
    )
    starts = (
        blocks.withColumn("_block_start", _sum_before(in_coarse))
        .join(coarse_starts, [*groups, *keys, "_coarse"])
        .select(*groups, *keys, "_block", (F.col("_coarse_start") + F.col("_block_start")).alias("_start"))
    )
    place = F.row_number().over(Window.partitionBy(*groups, *keys, "_block").orderBy("_ordinal"))
    return (
        rows.join(starts, [*groups, *keys, "_block"])
        .withColumn(name, (F.col("_start") + place).cast("bigint"))
        .select(*df.columns, name)
    )


def _sum_before(window: WindowSpec) -> Column:
    """Sum of the counts that come before this one."""
    return F.coalesce(F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def collect_pages(
    df: DataFrame,
    group: Sequence[str],
    item: Column,
    rank: str = "rank",
    page_size: int = PAGE_SIZE,
    name: str = "items",
) -> DataFrame:
    """Ordered arrays of ``item``, at most ``page_size`` per row.

    A group of up to ``page_size`` rows gives one row; larger ones continue on
    further pages, so every item is kept and no array grows with the data.
    """
    page = F.floor((F.col(rank) - 1) / page_size).cast("bigint")
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("rank"), item.alias("item"))))
    return (
        df.withColumn("page", page)
        .groupBy(*group, "page")
        .agg(ordered.alias(name))
        .withColumn(name, F.transform(name, lambda x: x["item"]))
    )
