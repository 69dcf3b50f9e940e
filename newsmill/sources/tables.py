"""Stored tables: raw hand-over, JSON records at the edge, union of sources."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill import schemas

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"


def article_columns(df: DataFrame) -> DataFrame:
    return df.select("id", "title", "url", "source", "source_type", "content",
                     "published_at", "scraped_at", "source_ord", "pos")


def union_sources(by_type: Mapping[str, DataFrame | None]) -> DataFrame:
    """Bag union of the sources; absent ones (switched off) are skipped.

    ``source_ord`` records the order in which a run reads the sources.
    """
    unknown = set(by_type) - set(schemas.SOURCE_TYPES)
    if unknown:
        raise ValueError(f"unknown source types {sorted(unknown)}")
    frames = [
        article_columns(by_type[kind].withColumn("source_ord", F.lit(i)))
        for i, kind in enumerate(schemas.SOURCE_TYPES)
        if by_type.get(kind) is not None
    ]
    if not frames:
        return SparkSession.active().createDataFrame([], schemas.ARTICLE)
    return reduce(DataFrame.unionByName, frames)


def write_raw(articles: DataFrame, root: str, run_date: str) -> None:
    """Raw articles of a run, partitioned so that retention drops folders."""
    articles.write.mode("overwrite").partitionBy("source_type").parquet(f"{root}/run_date={run_date}")


def read_raw(spark: SparkSession, root: str, run_date: str) -> DataFrame:
    """Raw articles of a run; only that date's folder is listed and read."""
    return read_stored(spark, f"{root}/run_date={run_date}", schemas.ARTICLE + ", run_date date", root)


def read_stored(spark: SparkSession, path: str, schema: str, root: str | None = None) -> DataFrame:
    """A stored table, or part of one below ``root``; never written means empty."""
    try:
        return spark.read.schema(schema).option("basePath", root or path).parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_json(df: DataFrame, path: str) -> None:
    """JSON records, one per line; files split on partition boundaries."""
    df.write.mode("overwrite").json(path, timestampFormat=ISO_MILLIS, ignoreNullFields=False)


def read_json(spark: SparkSession, path: str, schema: str, arrays: bool = False) -> DataFrame:
    """Read JSON records with a fixed schema; text that is not JSON is an error.

    ``arrays=True`` reads files that hold one JSON array each, the hand-over
    format of small producers. There a file without content is an error too.
    """
    if arrays:
        _require_content(spark, path)
    return spark.read.schema(schema).json(path, multiLine=arrays, mode="FAILFAST", timestampFormat=ISO_MILLIS)


def _require_content(spark: SparkSession, path: str) -> None:
    """Spark plans no read for an empty file, so it is missing from the scan.

    Only names and sizes are looked at, which Spark has listed already.
    """
    files = spark.read.format("binaryFile").load(path)
    listed, scanned = len(files.inputFiles()), files.select("path").count()
    if listed > scanned:
        raise ValueError(f"{listed - scanned} empty file(s) in {path}")
