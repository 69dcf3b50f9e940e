import zlib

from pyspark.sql import functions as F

from newsmill.llm import catalog, lang_id

SF_DIR = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    found = catalog.op2_language_id(spark, SF_DIR)
    truth = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held_out = [r for r in rows if r.held_out]
    assert held_out and sum(r.lang == r.lang_pred for r in held_out) >= 0.98 * len(held_out)
    assert all(0 <= r.score <= 1 for r in rows)


ROWS = [(0, "cat", "en", 1.0, 10), (0, "chat", "fr", 1.0, 10), (2, "at", "en", 0.5, 10), (1, "c", "fr", 0.25, 10)]


def test_words_come_before_grams_and_long_grams_before_short():
    scorer = lang_id.Scorer(lang_id.compact(ROWS, 2), max_n=2)
    miss = [1 + lang_id.PENALTY] * 2  # log10 of a total of 10, and the penalty
    assert scorer.word("cat").tolist() == [1.0, miss[1]]
    assert scorer.word("bat").tolist() == [0.5, miss[1]]  # " b", "ba", "at", "t "
    assert scorer.word("cc").tolist() == [miss[0], 0.25]
    assert scorer.text("cat bat")[0] == "en" and scorer.text("CHAT")[0] == "fr"


def test_no_letters_and_ties():
    scorer = lang_id.Scorer(lang_id.compact(ROWS, 2), max_n=2)
    assert scorer.text(None) == scorer.text("") == scorer.text("12 !?") == (lang_id.UNKNOWN, 0.0)
    assert scorer.text("zzz") == ("en", 0.5)
    assert lang_id.Scorer(lang_id.compact([], 2), 2).text("cat") == (lang_id.UNKNOWN, 0.0)


def test_sample_is_bounded(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), "id").alias("text"), F.lit("en").alias("lang"))
    picked, langs = lang_id._sample(docs, "doc_id", "lang", 300)
    assert langs == 1 and 200 < picked.count() < 400


def test_sample_needs_no_python_rows(spark):
    docs = spark.range(30).select(F.col("id").alias("doc_id"), F.lit("w").alias("text"), F.lit("en").alias("lang"))
    plan = lang_id._sample(docs, "doc_id", "lang", 300)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan


def test_model_is_bounded(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("wort"), F.chr(97 + F.col("id") % 26)).alias("text"), F.lit("de").alias("lang"))
    rows = lang_id.train(docs, settings=lang_id.Settings(max_items=60))
    assert 0 < len(rows) <= 60


def test_odd_rows(spark, odd_docs, no_docs):
    model = lang_id.train(odd_docs)
    rows = lang_id.predict(spark, odd_docs, model).collect()
    assert len(rows) == 8
    for r in rows:
        assert r.lang_pred == ("en" if r.text and r.text.strip() else "und")
    kept = lang_id.accepted(spark, odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["4", "5", "5", "None"]
    assert lang_id.accepted(spark, no_docs).count() == 0


def test_rare_words_stay_in_the_model(spark):
    word = F.translate(F.lower(F.conv(F.col("id").cast("string"), 10, 26)), "0123456789", "qrstuvwxyz")
    words = spark.range(60_000).select((F.col("id") % 1500).alias("doc_id"), word.alias("word"))
    docs = words.groupBy("doc_id").agg(F.concat_ws(" ", F.collect_list("word")).alias("text")).withColumn("lang", F.lit("en"))
    assert sum(r[0] == 0 for r in lang_id.train(docs)) == 60_000


def test_texts_in_unlearnt_scripts_and_gibberish_go(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang").filter("text is not null").limit(300)
    odd = ["Это совсем другой язык и другое письмо " * 50, "这是 一个 中文 文本 " * 50, "xqzvk wqrtzp kkjhg vvbnmq zzxcw qqpwrt " * 50, "هذا نص عربي " * 50]
    both = docs.withColumn("doc_id", F.col("doc_id").cast("string")).unionByName(
        spark.createDataFrame([(f"odd{i}", t, None) for i, t in enumerate(odd)], "doc_id string, text string, lang string")
    )
    kept = [r.doc_id for r in lang_id.accepted(spark, both).collect()]
    assert len(kept) == docs.count() and not any(k.startswith("odd") for k in kept)
