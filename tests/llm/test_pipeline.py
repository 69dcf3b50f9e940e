import hashlib

import corpus_pipeline
from newsmill.llm import bpe, catalog, oracles

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    """Each stage on all that its predecessor kept, against the stage's own brute force elsewhere."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).collect(), docs.schema)
        kept = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == columns and set(kept) <= ids, name
        if name == "pii":
            assert set(kept) == ids and any(kept[i] != texts[i] for i in kept)
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        else:
            assert all(kept[i] == texts[i] for i in kept)
        ids = set(kept)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in last} == ids and all(r.exact for r in last)
    own = bpe.build_encoding(bpe.read_ranks(catalog.public_tokenizers.path(catalog.RANKS)), catalog.public_tokenizers.PATTERN)
    assert all(r.ids == own.encode_ordinary(kept[r.doc_id]) for r in last[:20])


def test_a_task_has_one_python_worker(spark):
    """Workers of two evaluations in a stage are held together, and kept for all that follows."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(50)
    for name, stage in corpus_pipeline.STAGES:
        plan = stage(spark, docs, SF_DIR)._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("MapInArrow") <= 1, name


def test_decisions_take_effect(spark):
    rows = [
        (1, "the words of this text are of no use", "en", "s", 5), (2, "les mots de ce texte ne servent pas", "fr", "s", 5),
        (3, "12345", "en", "s", 5), (4, None, None, None, None), (5, "the words of this text are of no use", "en", "s", 5),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    docs = stages["language_id"](spark, docs, SF_DIR)
    assert {r.doc_id for r in docs.collect()} == {1, 2, 5}
    docs = stages["near_dedup"](spark, docs, SF_DIR)
    assert {r.doc_id for r in docs.collect()} == {1, 2}
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first()
    dirty = spark.createDataFrame([(9, f"so {item.text} so", "en", "s", 5), (1, rows[0][1], "en", "s", 5)], docs.schema)
    assert {r.doc_id for r in stages["decontamination"](spark, dirty, SF_DIR).collect()} == {1}


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.count() > 0 and rows.filter("not exact").count() == 0


def test_queries_match_their_sql(spark):
    from parity import compare, connect

    con = connect(SF_DIR)
    for name, sql in catalog.oracle_sql().items():
        assert compare(spark, con, name, catalog.queries()[name], sql, SF_DIR) == "", name
    with_sql = {"op4_near_dups", "op8_licenses", "op10_decontamination", "op11_fill_in_middle", "op12_source_divergence"}
    assert set(oracles.SQL) == with_sql


def test_bpe_query_like_the_library(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    own = bpe.build_encoding(bpe.read_ranks(catalog.public_tokenizers.path(catalog.RANKS)), catalog.public_tokenizers.PATTERN)
    for r in catalog.op3_byte_bpe(spark, SF_DIR).collect():
        ids = own.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
