"""Session settings the library relies on, and its shared work folder."""

from __future__ import annotations

import atexit
import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Results depend on these: times are UTC, and a JSON reply that repeats a key
# keeps the last value.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Only speed depends on these.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Stream state on disk instead of in memory.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to an existing session."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "newsmill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**TUNING, **REQUIRED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder named in ``spark.checkpoint.dir``.

    Only a session that runs in one process may leave the setting out. It then
    gets a folder of its own, which goes when that process ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _own_folder()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@functools.cache
def _own_folder() -> str:
    folder = tempfile.TemporaryDirectory(prefix="newsmill-", ignore_cleanup_errors=True)
    atexit.register(folder.cleanup)
    return folder.name


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the work folder and read it back.

    For results that a plan uses more than once: they are computed once, and
    survive the loss of executors.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
