"""Connected components of a link table, as Spark jobs on tables of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmill.session import materialize

#: Every round at least halves the height of the trees, so this is never met.
MAX_ROUNDS = 60


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Tie neighbours to the smallest node near by.

    ``both_ways``: all neighbours count and the larger ones are tied; else each
    node counts with its smaller neighbours only, and all of them are tied.
    """
    if both_ways:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("hub"), F.least("m", "u").alias("m"))
    tied = near.join(least, F.col("u") == F.col("hub"))
    if both_ways:
        tied = tied.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        own = least.select(F.col("hub").alias("u"), F.col("m").alias("v"))
        tied = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)
    return tied.filter(F.col("u") != F.col("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    """What changes whenever the pairs do."""
    hashes = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count("*"), hashes).first())


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """Rows ``(u, v)``: each node but the smallest of its component, and the smallest.

    ``links`` has pairs ``(u, v)`` in any order; loops, nulls and repeated pairs
    do no harm. Alternates large and small stars until nothing changes; the pairs
    never outnumber the links, and each round is written to the shared folder.
    """
    edges = materialize(links.filter(F.col("u") != F.col("v")).select("u", "v").distinct(), label)
    mark = _mark(edges)
    for _ in range(MAX_ROUNDS):
        before, edges = mark, materialize(_star(_star(edges, both_ways=True), both_ways=False), label)
        mark = _mark(edges)
        if mark == before:
            return edges
    raise RuntimeError("components did not settle")
