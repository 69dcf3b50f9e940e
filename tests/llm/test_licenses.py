import random

from newsmill.llm import decontaminate, licenses


def test_retrieval_misses_nothing(spark):
    """Every notice, whole or with a word changed, somewhere in other words."""
    rng = random.Random(9)
    other = lambda: " ".join(f"w{rng.randrange(900)}" for _ in range(rng.randrange(70)))
    rows, expected = [], set()
    for name, group in licenses.TEMPLATES.items():
        for text in group:
            for i in range(6):
                words = text.split()
                if i % 2 and len(words) > 40:
                    words[rng.randrange(len(words))] = "changed"
                rows.append((len(rows), f"{other()} {' '.join(words).upper() if i == 4 else ' '.join(words)} {other()}"))
                expected.add((len(rows) - 1, name))
    rows += [(1000 + i, f"{other()} licensed under the apache of {other()}") for i in range(10)]
    found = licenses.scan(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # A changed word may take the words of the version with it, but makes no other license.
    marked = {(r.doc_id, r.license) for r in found}
    assert marked <= expected and len(expected - marked) <= 3
    assert {(i, name) for i, name in expected if i % 6 != 1 and i % 6 != 3 and i % 6 != 5} <= marked
    assert all(r.doc_id < 1000 and 0.8 <= r.containment <= 1 for r in found)


def test_place_and_part(spark):
    rows = [(1, "x y licensed under CC BY-NC 4.0. z"), (2, "licensed under CC BY-NC")]
    found = licenses.scan(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.license, r.first_word, r.containment) for r in found] == [(1, "CC-BY-NC-4.0", 2, 1.0)]


def test_odd_rows(spark, odd_docs, no_docs):
    assert licenses.scan(spark, odd_docs).count() == 0
    assert licenses.scan(spark, no_docs).count() == 0
    short = {"own": ("The cat sat on the mat.", "", "mat")}
    found = licenses.scan(spark, odd_docs, templates=short).collect()
    assert [(r.doc_id, r.license) for r in found] == [(5, "own")]
    assert licenses.scan(spark, odd_docs, templates={}).count() == 0


def test_word_hashes_ignore_ascii_case_only(spark):
    df = spark.createDataFrame([("ABC é É",), ("abc é é",)], "text string")
    a, b = (r.w for r in df.select(decontaminate.word_hashes(df.text).alias("w")).collect())
    assert a[0] == b[0] and a[1] == b[1] and a[2] != b[2] and b[1] == b[2]


def test_versions_are_told_apart(spark):
    gnu = "licensed under the GNU General Public License, version {}."
    rows = [(i, text) for i, texts in enumerate(licenses.TEMPLATES.values()) for text in texts]
    rows += [(100, "This work is " + gnu.format(2)), (101, "all work is " + gnu.format(3)), (102, "This work is " + gnu.format(4))]
    # The notice of one version beside that of another in one text: both are found.
    two, three = (licenses.TEMPLATES[name][-1] for name in ("GPL-2.0", "GPL-3.0"))
    rows.append((103, f"{two} and some of these files differ {three}"))
    found = licenses.scan(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    names = list(licenses.TEMPLATES)
    of = {i: {r.license for r in found if r.doc_id == i} for i, _ in rows}
    assert all(of[i] == {name} for i, name in enumerate(names))
    assert (of[100], of[101], of[102], of[103]) == ({"GPL-2.0"}, {"GPL-3.0"}, set(), {"GPL-2.0", "GPL-3.0"})
