import random

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from newsmill.llm import common, near_dups
from newsmill.llm.common import WordHashes
from newsmill.llm.components import components


def brute_force(rows, percent=85, size=5):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        grams = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)] or ([tuple(words)] if words else [])
        sets.append(set(grams))
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[max(top(i), top(j))] = min(top(i), top(j))
    return {rows[i][0]: (len(sets[i]), rows[top(i)][0]) for i in range(len(rows))}


def variants(rng, base, copies, edits):
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        yield " ".join(words)


@pytest.mark.parametrize("percent", [80, 85])
def test_like_brute_force(spark, percent):
    rng = random.Random(percent)
    texts = [None, "", "  ", "one", "One", "one two three four", "one two three four five", "one two three four five six"]
    for n in (8, 40, 150):
        base = [f"w{rng.randrange(500)}" for _ in range(n)]
        texts += list(variants(rng, base, 40, 4)) + [" ".join(base)] * 3
    # A chain: neighbours are alike, its ends are not.
    chain = [f"c{i}" for i in range(300)]
    texts += [" ".join(chain[5 * i : 5 * i + 200]) for i in range(12)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dups.near_duplicates(docs, settings=near_dups.Settings(percent=percent, bands=42)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_force(rows, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_bins_are_full_and_agree_as_often_as_the_sets():
    sketcher = near_dups.Sketcher(near_dups.Settings(bands=64, rows=6))
    hashes = WordHashes(lambda w: hash(w) % (1 << 64))
    same = near_dups.shingle_set("a b c d e f g", hashes, 5)
    assert (sketcher.bins_of(same) != 0).all()
    rng = random.Random(1)
    agreed = []
    for _ in range(60):
        shared = [rng.getrandbits(64) for _ in range(40)]
        sets = [near_dups.np.unique(near_dups.np.array(shared + [rng.getrandbits(64) for _ in range(5)], near_dups.np.uint64)) for _ in "ab"]
        agreed.append((sketcher.bins_of(sets[0]) == sketcher.bins_of(sets[1])).mean())
    assert abs(sum(agreed) / len(agreed) - 40 / 50) < 0.03


def test_odd_rows(spark, odd_docs, no_docs):
    found = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dups.near_duplicates(odd_docs).collect()}
    assert found == {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 2, 5, True), (None, 1, None, True),
                     (None, 0, None, True)}
    kept = near_dups.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "5", "None", "None"]
    assert near_dups.near_duplicates(no_docs).count() == 0
    assert near_dups.deduplicated(no_docs).count() == 0


def test_hot_group_of_copies_meets_once(spark):
    docs = spark.range(2000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("same old words all over again")).otherwise(F.concat(F.lit("only here is "), "id", F.lit(" said"))).alias("text"),
    )
    found = near_dups.near_duplicates(docs)
    assert found.filter("component_id = 0").count() == 667
    assert found.filter("kept").count() == 2000 - 666


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 150)] + [(7, 7)]
    found = {r.u: r.v for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(1, 51)} | {i: 100 for i in range(101, 150)}


def test_a_family_below_the_threshold_writes_few_pairs(spark, monkeypatch):
    """Copies that share buckets but few links: what is written grows with the copies, not with their pairs."""
    written = {}
    store = near_dups.materialize

    def counted(df, label):
        made = store(df, label)
        if label in ("near-pairs", "near-links", "near-mixed"):
            written[label] = made.count()
        return made

    monkeypatch.setattr(near_dups, "materialize", counted)
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(170)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(4):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    found = near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_force(rows)
    assert len({r.component_id for r in found}) > 100  # most of the copies link with nobody
    assert written["near-links"] < 400 and written["near-pairs"] < 32 * 400


@pytest.mark.parametrize("limits", [(3, 1 << 21), (512, 400)])
def test_small_blocks_find_the_same(spark, limits, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK_MEMBERS", limits[0])
    monkeypatch.setattr(near_dups, "BLOCK_SHINGLES", limits[1])
    monkeypatch.setattr(near_dups, "PAIRS_OF_HUB", 4)
    rng = random.Random(9)
    rows = list(enumerate(variants(rng, [f"w{i}" for i in range(120)], 60, 6)))
    found = near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_force(rows)


def test_only_repeated_keys_are_put_in_order(spark):
    """Texts of keys that are there once go through no window, and of a repeated key the first text stays."""
    docs = spark.createDataFrame([(i, f"these are the very own words of row {i} and of no other") for i in range(50)], "doc_id long, text string")
    plan = near_dups.deduplicated(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    more = docs.unionByName(spark.createDataFrame([(7, "another text of row seven"), (7, None)], docs.schema))
    kept = near_dups.deduplicated(more)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(50))
    assert [r.text for r in kept.filter("doc_id = 7").collect()] == ["another text of row seven"]


def test_sets_of_a_batch_are_those_of_each_text(monkeypatch):
    """No words are remembered between batches: the sets come from the words of some texts at a time."""
    monkeypatch.setattr(common, "SPLIT_BYTES", 60)
    hashes = WordHashes(xxhash.xxh3_64_intdigest)
    texts = [None, "", " \n", "One", "the quick Brown fox jumps over the lazy dog " * 3, *[f"w{i} " * i for i in range(12)]]
    sets = list(near_dups.shingle_sets(pa.array(texts), 5))
    assert [s.tolist() for s in sets] == [near_dups.shingle_set(t, hashes, 5).tolist() for t in texts]
    assert list(near_dups.shingle_sets(pa.array([], pa.string()), 5)) == []
