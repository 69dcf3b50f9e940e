"""Retention: which run dates of each dataset are past their keep period."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Days each dataset is kept.
KEEP_DAYS = {"raw": 7, "processed": 30, "digests": 90, "sent_ids": 90}


def retained(df: DataFrame, dataset: str, as_of: str, date: str = "run_date") -> DataFrame:
    """Rows still kept; on a table partitioned by ``date`` old folders are not read."""
    return df.filter(F.col(date) >= F.date_sub(F.lit(as_of).cast("date"), KEEP_DAYS[dataset]))


#: The column that each stored dataset is partitioned by.
DATE_COLUMNS = {"raw": "run_date", "processed": "run_date", "digests": "digest_date", "sent_ids": "sent_date"}


def expired_partitions(datasets: Mapping[str, DataFrame], as_of: str) -> DataFrame:
    """Report (dataset, run_date, rows) past the keep period, by each dataset's own date; deletes nothing."""
    reports = []
    for dataset, df in datasets.items():
        date = DATE_COLUMNS[dataset]
        old = df.filter(F.col(date) < F.date_sub(F.lit(as_of).cast("date"), KEEP_DAYS[dataset]))
        counts = old.groupBy(F.col(date).alias("run_date")).agg(F.count("*").alias("n_rows"))
        reports.append(counts.select(F.lit(dataset).alias("dataset"), "run_date", "n_rows"))
    report = reports[0]
    for other in reports[1:]:
        report = report.unionByName(other)
    return report


def stored_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored Parquet table whose row counts Spark takes from file footers.

    Counts by partition column are pushed into this reader, so they read one footer
    per file and no data pages. The plain reader makes a batch of empty rows instead.
    """
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    plain = spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.conf.set("spark.sql.sources.useV1SourceList", ",".join(f for f in plain.split(",") if f != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", plain)


def expired_stored(spark: SparkSession, paths: Mapping[str, str], as_of: str) -> DataFrame:
    """``expired_partitions`` of stored tables, from folder names and file footers alone."""
    return expired_partitions({dataset: stored_table(spark, path) for dataset, path in paths.items()}, as_of)
