"""From raw documents to token ids, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``; its
result is written and read again as the next one's ``docs``. All but the last
return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.llm import bpe, decontaminate, lang_id, near_dups, pii
from newsmill.llm.catalog import PII_KEY, RANKS
from newsmill.llm.common import table
from newsmill.session import materialize, work_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the documents' own labels teach."""
    return lang_id.accepted(spark, docs)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dups.deduplicated(docs, settings=near_dups.Settings(percent=80, bands=42))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def pseudonymous(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data; ``n_chars`` follows the text."""
    replaced = pii.pseudonymize(spark, docs, PII_KEY)
    if "n_chars" in docs.columns:
        replaced = replaced.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars"))
    return replaced.select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, which decode to its text: one more column tells.

    Ids are written before they are decoded. In one stage each task would hold two Python
    workers, and Spark keeps all of them in turn for whatever runs later.
    """
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    ids = bpe.encode(spark, docs.select("doc_id", "lang", "source", "text"), path, pattern)
    ids = materialize(ids, "pipeline-ids")
    back = bpe.decode(spark, ids, path, pattern)
    exact = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return back.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", exact.alias("exact"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", recognised),
    ("near_dedup", unique),
    ("decontamination", uncontaminated),
    ("pii", pseudonymous),
    ("byte_bpe", encoded),
]
#: Learned languages, keyed surrogates and token merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
