import random
import re

from newsmill.llm import catalog, quality
from newsmill.llm.common import WordHashes

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeated)


def test_base_numbers():
    rng, hashes = random.Random(3), WordHashes(hash)
    hashes = WordHashes(lambda w: hash(w) % (1 << 64))
    texts = [None, "", " \n ", "a", "a b", "a b c a b c", "x\nx\n \n \nx"]
    texts += ["".join(rng.choice(["a ", "b ", "é", "\n", "#", "\t", "\x0b", " ", "< "]) for _ in range(80)) for _ in range(200)]
    for text in texts:
        assert quality.base_numbers(text, hashes) == brute_force(text)


def test_held_out_labels(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = quality.train(docs, labels.filter(F.col("doc_id") % 3 != 0))
    rows = quality.judge(spark, docs, model).join(labels.filter(F.col("doc_id") % 3 == 0), "doc_id").collect()
    right = sum((r.quality >= 0.5) == bool(r[-2]) for r in rows)
    assert len(rows) > 10 and right >= 0.8 * len(rows)


def test_query_follows_the_base_rules(spark):
    rows = catalog.op5_quality(spark, SF_DIR).collect()
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept) and 0 <= r.quality <= 1


def test_one_class_and_no_labels(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 1), (5, 1), (None, 0), (4, None), (9, 7)], "doc_id long, quality int")
    for marks, kept in ((labels, True), (labels.limit(0), True)):
        model = quality.train(odd_docs, marks)
        rows = quality.judge(spark, odd_docs, model, quality.Settings(min_words=1)).collect()
        assert [r.kept for r in rows if r.text and r.text.startswith("The")] == [kept, kept]
        assert all(r.base_failed for r in rows if not r.text)
    assert quality.judge(spark, no_docs, model).count() == 0


def test_sample_is_bounded(spark):
    marks = spark.range(4000).selectExpr("id as key", "cast(id % 2 as int) as label")
    assert 150 < quality.sample(marks, quality.Settings(rows_per_class=100)).count() < 260
