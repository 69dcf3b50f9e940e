"""What was already sent: look-back sets, anti join, writing and back-fill."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill import schemas
from newsmill.sources.tables import read_stored

LOOKBACK_DAYS = 7


def read_sent(spark: SparkSession, root: str) -> DataFrame:
    """The sent-id table; a table that was never written is empty."""
    return read_stored(spark, root, schemas.SENT_ID)


def seen_window(sent: DataFrame, date: str, lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """Distinct ids sent on the ``lookback`` days before ``date``.

    With ``sent`` partitioned by ``sent_date`` only those partitions are read.
    """
    day = F.lit(date).cast("date")
    window = F.col("sent_date").between(F.date_sub(day, lookback), F.date_sub(day, 1))
    return sent.filter(window).select("id").distinct()


def seen_windows(sent: DataFrame, lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """``seen_window`` of every date at once, as (run_date, id)."""
    days = F.sequence(F.date_add("sent_date", 1), F.date_add("sent_date", lookback))
    return sent.distinct().select(F.explode(days).alias("run_date"), "id").distinct()


def unseen(df: DataFrame, seen: DataFrame, on: tuple[str, ...] = ("id",)) -> DataFrame:
    return df.join(seen, list(on), "left_anti")


def unseen_by_date(df: DataFrame, sent: DataFrame, lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """``unseen`` for rows of many run dates at once.

    The date range is a condition of the join on id, so the sent table is not
    multiplied by the days it counts for.
    """
    days = F.date_diff(F.col("a.run_date"), F.col("s.sent_date"))
    match = (F.col("a.id") == F.col("s.id")) & days.between(1, lookback)
    return df.alias("a").join(sent.select("id", "sent_date").alias("s"), match, "left_anti")


def save_sent(included: DataFrame, root: str, date: str, mode: str = "overwrite") -> None:
    """Write the ids sent on ``date``, replacing those of an earlier run.

    The partition's own path is overwritten: unlike dynamic partition
    overwrite this also clears it when nothing was sent. ``mode="append"``
    keeps the ids of earlier runs of that day.
    """
    dt.date.fromisoformat(date)
    included.select("id").write.mode(mode).parquet(f"{root}/sent_date={date}")


@dataclass(frozen=True)
class BucketedSent:
    """The sent ids as a table that is dealt out by id once, when they are written.

    ``buckets`` folders of hash values per date stand below ``root``: a join on id reads them
    in place, and only the other side is shuffled, into as many partitions. The
    number should follow the size of the ids of the look-back, and stays as it is.
    """

    root: str
    buckets: int

    @property
    def name(self) -> str:
        return "sent_" + hashlib.sha256(self.root.encode()).hexdigest()[:16]

    def open(self, spark: SparkSession) -> DataFrame:
        """The table, with the dates that other sessions have written."""
        if not spark.catalog.tableExists(self.name):
            spark.sql(
                f"CREATE TABLE {self.name} (id STRING, sent_date DATE) USING parquet PARTITIONED BY (sent_date) "
                f"CLUSTERED BY (id) INTO {self.buckets} BUCKETS LOCATION '{self.root}'"
            )
            # No rows, but the folder, which the search for partitions needs.
            spark.createDataFrame([], schemas.SENT_ID).write.insertInto(self.name)
        spark.catalog.recoverPartitions(self.name)
        return spark.table(self.name)

    def save(self, included: DataFrame, date: str) -> None:
        """Write the ids sent on ``date``, replacing those of an earlier run."""
        dt.date.fromisoformat(date)
        spark = included.sparkSession
        self.open(spark)
        spark.sql(f"INSERT OVERWRITE {self.name} PARTITION (sent_date = DATE'{date}') SELECT id FROM {{df}}", df=included.select("id"))

    def append(self, sent: DataFrame) -> None:
        """Add ids of many dates, ``(id, sent_date)``."""
        self.open(sent.sparkSession)
        sent.select("id", "sent_date").write.insertInto(self.name)


def send_decisions(days: DataFrame, lookback: int = LOOKBACK_DAYS, carry: Sequence[str] = ()) -> DataFrame:
    """Replay the daily seen check over many days in one shuffle.

    ``days`` holds (id, run_date, included). For each appearance the result
    tells whether the id counted as seen and whether it was sent. An id is
    seen when it was *sent* at most ``lookback`` days earlier, so the fold
    carries the last send, not the last appearance. The array per id has one
    entry per date, whatever the number of copies. Counts named in ``carry``
    are summed per id and date.
    """
    sums = [F.sum(c).alias(c) for c in carry]
    daily = days.groupBy("id", "run_date").agg(F.max("included").alias("included"), *sums)
    visits = F.array_sort(F.collect_list(F.struct("run_date", "included", *carry)))
    extra = "".join(f",{c}:bigint" for c in carry)
    empty = F.struct(
        F.lit(None).cast("date").alias("last"),
        F.array().cast(f"array<struct<run_date:date,seen:boolean,sent:boolean{extra}>>").alias("out"),
    )

    def step(acc, visit):
        seen = F.coalesce(F.date_diff(visit["run_date"], acc["last"]) <= lookback, F.lit(False))
        sent = visit["included"] & ~seen
        entry = F.struct(
            visit["run_date"].alias("run_date"),
            seen.alias("seen"),
            sent.alias("sent"),
            *[visit[c].alias(c) for c in carry],
        )
        return F.struct(
            F.when(sent, visit["run_date"]).otherwise(acc["last"]).alias("last"),
            F.concat(acc["out"], F.array(entry)).alias("out"),
        )

    return (
        daily.groupBy("id")
        .agg(visits.alias("visits"))
        .select("id", F.inline(F.aggregate("visits", empty, step, lambda acc: acc["out"])))
    )


def seen_backfill(days: DataFrame, lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """(id, sent_date) of every send over the replayed days."""
    sent = send_decisions(days, lookback).filter("sent")
    return sent.select("id", F.col("run_date").alias("sent_date"))
