"""The queries of this folder, each over a whole given table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.llm import bpe, decontaminate, divergence, fim, html_text, lang_id, licenses, near_dups, ngram_lm, oracles, pii, quality, secrets, token_files
from newsmill.llm.common import id_fold, table
from newsmill.session import work_dir

#: The key of the registered queries; real runs pass a secret one.
PII_KEY = b"newsmill"
RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
#: Words of the longest n-grams of the language model.
NGRAM_ORDER = 3


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(spark, table(spark, sf_dir, "documents", "doc_id", "text"), PII_KEY)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = id_fold(F.col("doc_id"), 5) == 0
    model = lang_id.train(docs.filter(~held_out))
    judged = lang_id.predict(spark, docs.select("doc_id", "text"), model, keep=["doc_id"])
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    encoded = bpe.encode(spark, docs, path, pattern, keep=["doc_id"])
    decoded = bpe.decode(spark, encoded, path, pattern)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.judge(spark, docs, model, keep=["doc_id"])


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_text.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"), keep=["page_id", "url"])
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op7_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = id_fold(F.col("doc_id"), 10) == 0
    model = ngram_lm.train(spark, docs.filter(~held_out), order=NGRAM_ORDER)
    return ngram_lm.score(spark, docs, model, keep=["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        "base_score", "score", "perplexity",
    )


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(spark, table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    found = secrets.scan(docs, learn_from=id_fold(F.col("key"), 5) != 0)
    finding = F.sha2(F.col("finding").cast("binary"), 256).alias("finding_sha256")
    return found.select("doc_id", "place", "ordinal", finding, F.round("score", 6).alias("score"), "is_secret")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cuts = fim.restore(fim.transform(table(spark, sf_dir, "documents", "doc_id", "text"), keep=["doc_id"]))
    return cuts.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents", "text", "lang", "source"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "token-files")
    token_files.write(spark, table(spark, sf_dir, "documents", "doc_id", "text"), folder, public_tokenizers.path(TOKENIZER))
    return token_files.read(spark, folder)


REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_surrogates": op1_pii_surrogates,
    "op2_language_id": op2_language_id,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_near_dups": op4_near_dups,
    "op5_quality": op5_quality,
    "op6_main_text": op6_main_text,
    "op7_ngram_lm": op7_ngram_lm,
    "op8_licenses": op8_licenses,
    "op9_secrets": op9_secrets,
    "op10_decontamination": op10_decontamination,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_source_divergence": op12_source_divergence,
    "op13_token_files": op13_token_files,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(REGISTERED)


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, sql in oracles.SQL.items() if name in REGISTERED}
