"""Rows are told apart by key without shuffling those that meet no key."""

import pytest
from pyspark.sql import functions as F

from newsmill.llm import decontaminate, near_dups
from newsmill.llm.common import apart


@pytest.mark.parametrize("kind", ["long", "string", "struct<k:long,h:string>"])
def test_keys_are_all_in_the_second_part(spark, kind):
    key = F.struct(F.col("id").alias("k"), F.col("id").cast("string").alias("h")) if kind[:6] == "struct" else F.col("id").cast(kind)
    docs = spark.range(30_000).select(key.alias("id"), F.col("id").alias("n"), F.lit("x").alias("map_part"))
    docs = docs.unionByName(docs.limit(1).select(F.lit(None).cast(kind).alias("id"), F.lit(-1).cast("long").alias("n"), "map_part"))
    keys = docs.filter("n % 4 = 1").select("id")  # more than one bitmap
    clear, rest = apart(docs, "id", keys)
    assert clear.columns == rest.columns == docs.columns
    clear, rest = ({r.n for r in df.select("n").collect()} for df in (clear, rest))
    assert not clear & rest and clear | rest == {-1, *range(30_000)}
    assert {n for n in range(30_000) if n % 4 == 1} <= rest
    assert len(rest) < 1.15 * 7_500 + 0.02 * 30_000 + 2_000  # about 6 in 100 of the others
    none, all_of = apart(docs, "id", keys.limit(0))[::-1]
    assert none.isEmpty() and all_of.count() == 30_001


def _nodes(plan):
    yield plan
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        yield from _nodes(plan.executedPlan())
    elif name.endswith("QueryStage"):
        yield from _nodes(plan.plan())
    for i in range(plan.children().size()):
        yield from _nodes(plan.children().apply(i))


def _texts_dealt_out(df):
    """The rows, and how many with a text went through exchanges that no broadcast makes."""
    rows = df.collect()
    stages = {x.id(): x for x in _nodes(df._jdf.queryExecution().executedPlan()) if x.nodeName() == "Exchange" and "text#" in x.output().toString()}
    return rows, sum(x.metrics().apply("shuffleRecordsWritten").value() for x in stages.values())


@pytest.fixture
def large_tables(spark):
    """Joins take no table for small unless they are told to."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, -1)
    yield
    spark.conf.set(name, before)


def _own_words(i):
    return " ".join(f"w{(i * 7919 + j * j * 31) % 100_003}" for j in range(30))


def test_few_texts_are_dealt_out_by_deduplication(spark, large_tables):
    rows = [(i, _own_words(i - i % 10 if i % 10 == 1 else i)) for i in range(2000)]
    rows += [(7, "another text of row seven"), (7, None), (None, "no key"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept, dealt = _texts_dealt_out(near_dups.deduplicated(docs))
    assert sorted(str(r.doc_id) for r in kept) == sorted([str(i) for i in range(2000) if i % 10 != 1] + ["None"] * 2)
    assert 0 < dealt < 2 * 0.2 * len(rows)  # 10 in 100 are copies; those that repeat a key are looked up twice


def test_few_texts_are_dealt_out_by_decontamination(spark, large_tables):
    items = spark.createDataFrame([("a", _own_words(3)), ("b", _own_words(50_001))], "item_id string, text string")
    docs = spark.createDataFrame([(i, _own_words(i)) for i in range(2000)] + [(3, "clean"), (None, None)], "doc_id long, text string")
    kept, dealt = _texts_dealt_out(decontaminate.clean(docs, items))
    assert len(kept) == 2001 and [r.text for r in kept if r.doc_id == 3] == ["clean"]
    assert dealt < 0.1 * 2002
