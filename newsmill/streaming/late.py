"""Alarms over a stream that list what comes too late, instead of losing it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.operators.metrics import ERROR_THRESHOLD, signals
from newsmill.sources.tables import read_stored

#: Signals per five-minute window and alarm; a row of state has counts of an open window, or the watermark alone.
COUNTS = "window_start timestamp, alarm string, n bigint"
STATE = COUNTS + ", watermark timestamp, final boolean"
LATE = "ts timestamp, window_start timestamp, alarm string"
WINDOW = "5 minutes"
DELAY = dt.timedelta(minutes=10)


def _end() -> Column:
    return F.col("window_start") + F.expr(f"INTERVAL {WINDOW}")


def write_alarms(metrics: DataFrame, root: str, checkpoint: str, delay: dt.timedelta = DELAY) -> None:
    """Counts below ``root/counted`` and late signals below ``root/late``, for all that has landed; then stop.

    The watermark of a batch is the latest time of the batches before it less ``delay``.
    A signal whose window had ended by then is late: it is listed with its own time, and
    counts for no alarm. All others are counted, and a window is final, and an alarm if
    it reaches the threshold, as soon as the watermark after a batch has passed its end.

    Each batch reads the open windows that the one before it left and leaves its own, so
    what it reads does not grow with the history. Its two folders are written as a
    whole; a batch that runs again replaces them.
    """

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        state = read_stored(spark, f"{root}/counted/batch_id={number - 1}", STATE).filter(~F.coalesce("final", F.lit(False)))
        before = state.agg(F.max("watermark")).first()[0]
        latest = batch.agg(F.max("ts")).first()[0]
        reached = [t for t in (before, latest and latest - delay) if t is not None]
        after = F.lit(max(reached, default=None)).cast("timestamp")
        passed = F.lit(before).cast("timestamp")
        rows = batch.select("ts", F.window("ts", WINDOW)["start"].alias("window_start"), F.explode(signals()).alias("alarm"))
        late = F.coalesce(_end() <= passed, F.lit(False))
        rows.filter(late).write.mode("overwrite").parquet(f"{root}/late/batch_id={number}")
        own = rows.filter(~late).groupBy("window_start", "alarm").agg(F.count("*").alias("n"))
        counts = state.filter(F.col("n").isNotNull()).select("window_start", "alarm", "n").unionByName(own)
        counts = counts.groupBy("window_start", "alarm").agg(F.sum("n").alias("n"))
        final = F.coalesce(_end() <= after, F.lit(False))
        mark = spark.range(1).select(after.alias("watermark"))
        still = counts.withColumn("final", final).unionByName(mark, allowMissingColumns=True)
        still.write.mode("overwrite").partitionBy("final").parquet(f"{root}/counted/batch_id={number}")

    query = metrics.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def read_alarms(spark: SparkSession, root: str) -> DataFrame:
    """Final windows that reach the threshold."""
    counted = read_stored(spark, f"{root}/counted", STATE).filter(F.col("final") & (F.col("n") >= ERROR_THRESHOLD))
    return counted.select("window_start", "alarm", "n")


def read_late(spark: SparkSession, root: str) -> DataFrame:
    """Signals that came after their windows had ended, each with its time."""
    return read_stored(spark, f"{root}/late", LATE)
