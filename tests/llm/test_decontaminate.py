import random
import re

import pytest

from newsmill.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute_force(docs, items, window=10):
    out = {}
    for key, text in docs:
        own, hit, found = words(text), set(), set()
        for item, body in items:
            theirs = words(body)
            n = min(window, len(theirs))
            spans = {tuple(theirs[i : i + n]) for i in range(len(theirs) - n + 1)} if n else set()
            for i in range(len(own) - n + 1 if n else 0):
                if tuple(own[i : i + n]) in spans:
                    hit.update(range(i, i + n))
                    found.add(str(item))
        out[key] = (len(own), len(hit), sorted(found))
    return out


@pytest.mark.parametrize(("window", "gram"), [(10, 6), (10, 10), (10, 1), (5, 3)])
def test_like_brute_force(spark, window, gram):
    rng = random.Random(window * gram)
    say = lambda n, k: " ".join(rng.choice(["a", "B", "ç", "Ünter", "d1", "E.", "f,g"][:k]) for _ in range(n))
    items = [(i, say(rng.randint(0, 30), 7)) for i in range(12)] + [(90, None), (91, "a B"), (92, "solo"), (93, say(14, 2))]
    docs = [(i, say(rng.randint(0, 60), 7)) for i in range(30)] + [(100, None), (101, "ab A b solo"), (102, "a " * 300)]
    docs += [(200 + i, f"{say(20, 7)} {items[i][1]} {say(5, 7)}") for i in range(12)]
    found = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
        window=window, gram=gram,
    ).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found} == brute_force(docs, items, window)
    assert all(r.contaminated == (r.n_hit > 0) for r in found)


def test_large_benchmarks_are_joined_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    test_like_brute_force(spark, 10, 6)


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(None, "cat sat on"), (2, None), (3, "")], "item_id long, text string")
    found = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate.contamination(odd_docs, items).collect()}
    assert found == {1: (0, 0, []), 2: (0, 0, []), 3: (0, 0, []), 4: (60_000, 0, []), 5: (6, 3, []), None: (2, 0, [])}
    kept = decontaminate.clean(odd_docs, items)
    assert kept.columns == odd_docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "None", "None"]
    assert decontaminate.contamination(no_docs, items).count() == 0
    assert decontaminate.clean(odd_docs, items.limit(0)).count() == 8


def test_no_python_in_the_plan(spark, odd_docs):
    items = spark.createDataFrame([(1, "cat sat on the mat")], "item_id long, text string")
    plan = decontaminate.hits(odd_docs.selectExpr("struct(doc_id) as row_key", "text"), items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
