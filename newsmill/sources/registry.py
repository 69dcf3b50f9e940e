"""The source registry: which feeds and services are switched on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill import schemas


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """One row per registry file (a JSON object with rss, apis and social)."""
    return spark.read.schema(schemas.SOURCE_REGISTRY).json(path, multiLine=True, mode="FAILFAST")


def rss_sources(registry: DataFrame, *keep: str) -> DataFrame:
    """Every feed entry with its position; ``keep`` names columns to carry."""
    return registry.select(*keep, F.posexplode("rss").alias("registry_pos", "entry")).select(
        *keep, "registry_pos", "entry.*"
    )


def enabled_rss(registry: DataFrame, *keep: str) -> DataFrame:
    return rss_sources(registry, *keep).filter("enabled")


def api_gates(registry: DataFrame, *keep: str) -> DataFrame:
    """Whether each API source runs: the first entry of its type decides."""
    types = F.array(F.struct(F.lit("nvd").alias("source_type"), F.lit("NVD").alias("label")),
                    F.struct(F.lit("arxiv").alias("source_type"), F.lit("ArXiv").alias("label")))
    gates = registry.select(*keep, "apis", F.explode(types).alias("gate"))
    first = F.get(F.filter("apis", lambda a: a["type"] == F.col("gate.source_type")), F.lit(0))
    gates = gates.withColumn("enabled", F.coalesce(first["enabled"], F.lit(False)))
    error = F.concat("gate.label", F.lit(" source is disabled in sources.json"))
    return gates.select(*keep, "gate.source_type", "enabled", F.when(~F.col("enabled"), error).alias("error"))
