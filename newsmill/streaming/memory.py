"""What a stream remembers of its keys, as a table that stays as small as its days.

Every batch adds a folder of ``(key, latest time)``, partitioned by day. After each
``every`` batches all that is known is folded into one folder, one row per key, and days past
``keep_days`` are left out. Which folders a batch reads follows from its number alone:
the last fold and the batches since. A batch that runs again therefore finds what it found
before and replaces what it wrote, and what it reads does not grow with the history.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.sources.tables import read_stored


@dataclass(frozen=True)
class Memory:
    """``root``: its folder; ``time``: ``date`` or ``timestamp``; ``keep_days``: None forgets nothing."""

    root: str
    time: str = "timestamp"
    keep_days: int | None = None
    every: int = 16

    @property
    def _schema(self) -> str:
        return f"id string, at {self.time}, day date"

    def _known(self, spark: SparkSession, base: int, stop: int) -> DataFrame:
        """The fold before batch ``base`` and the batches from there up to ``stop``."""
        known = spark.createDataFrame([], self._schema)
        if base:
            known = read_stored(spark, f"{self.root}/folds/upto={base}", self._schema)
        if stop > base:
            paths = [f"{self.root}/batches/batch_id={n}" for n in range(base, stop)]
            # Folders of batches, so that days are pruned and the number is not a column.
            for path in paths:
                known = known.unionByName(read_stored(spark, path, self._schema))
        return known

    def read(self, spark: SparkSession, number: int) -> DataFrame:
        """``(id, at, day)`` of the batches before ``number``; filter on ``day`` and only those folders are read."""
        return self._known(spark, number - number % self.every, number)

    def write(self, rows: DataFrame, number: int) -> None:
        """Remember ``(id, at)`` of batch ``number``."""
        spark = rows.sparkSession
        dated = rows.select("id", F.col("at").cast(self.time).alias("at"), F.to_date("at").alias("day"))
        self._store(dated, f"{self.root}/batches/batch_id={number}")
        if (number + 1) % self.every == 0:
            self._fold(spark, number + 1)

    def _fold(self, spark: SparkSession, stop: int) -> None:
        known = self._known(spark, stop - self.every, stop).groupBy("id").agg(F.max("at").alias("at"))
        known = known.withColumn("day", F.to_date("at"))
        if self.keep_days is not None:
            newest = self.newest(self._known(spark, stop - self.every, stop))
            if newest is not None:
                known = known.filter(F.col("day") >= F.date_sub(F.lit(newest), self.keep_days))
        self._store(known, f"{self.root}/folds/upto={stop}")

    def _store(self, rows: DataFrame, path: str) -> None:
        rows.repartition("day").write.mode("overwrite").partitionBy("day").parquet(path)

    @staticmethod
    def newest(known: DataFrame):
        """The newest day, which Spark takes from the folders' names."""
        return known.agg(F.max("day").alias("day")).first().day
