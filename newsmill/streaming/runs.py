"""Running a stream over what has landed so far."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.session import work_dir
from newsmill.sources.tables import read_stored
from newsmill.streaming.memory import Memory

Step = Callable[[DataFrame, DataFrame], DataFrame]


def write_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything available into Parquet, then stop.

    Running it again with the same folders continues where it ended.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What ``write_batches`` has stored; nothing yet means empty."""
    return read_stored(spark, path, f"{schema}, batch_id bigint")


def write_batches(
    stream: DataFrame, path: str, checkpoint: str, step: Step, schema: str,
    memory: Memory | None = None, remember: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Store ``step(batch, earlier)`` of every available micro-batch, then stop.

    State is the stored table itself, or what ``memory`` holds of it: ``(id, at)`` rows that
    ``remember`` makes of each result. A batch has a folder of its own that is
    written as a whole, so a batch that is run again after a failure replaces its
    result, and it only sees those of earlier batches.
    """

    def store(batch: DataFrame, number: int) -> None:
        spark, own = batch.sparkSession, f"{path}/batch_id={number}"
        if memory is None:
            earlier = read_batches(spark, path, schema).filter(F.col("batch_id") < number).drop("batch_id")
        else:
            earlier = memory.read(spark, number)
        step(batch, earlier).write.mode("overwrite").parquet(own)
        if memory is not None:
            memory.write(remember(read_stored(spark, own, schema)), number)

    query = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def drain(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream into a fresh folder and read the result back."""
    spark = stream.sparkSession
    root = work_dir(spark, label)
    write_available(stream, f"{root}/out", f"{root}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


def drain_batches(stream: DataFrame, label: str, step: Step, schema: str) -> DataFrame:
    """``write_batches`` into a fresh folder, read back."""
    root = work_dir(stream.sparkSession, label)
    write_batches(stream, f"{root}/out", f"{root}/checkpoint", step, schema)
    return read_batches(stream.sparkSession, f"{root}/out", schema)
