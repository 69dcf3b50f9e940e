import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsmill.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = st.text(st.sampled_from("ab \n\t\x0b\x1c\x85\xa0é漢𝒳<P>SM"), max_size=40)


def by_steps(key, text):
    """The contract, unit by unit."""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def draw(key):
    return hashlib.sha256(f"42:{key}".encode()).hexdigest()


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.integers(-5, 10_000))
def test_equals_the_contract_and_comes_back(text, key):
    made = fim.cut(text, draw(key), fim.Settings())
    assert made == by_steps(key, text)
    assert fim.rebuild(made[4], made[1], fim.Settings()) == text


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 9))
def test_parts_have_the_same_units(text, part):
    assert list(fim.unit_ends(text, part)) == list(fim.unit_ends(text))


@pytest.mark.parametrize("text", ["ab cd " * 800_000, "a" * 3_000_000, " " * 3_000_000, "a\n" * 2_000_000])
def test_very_long_texts(text):
    n, form, _, _, output = fim.cut(text, draw(3), fim.Settings(rate=100))
    assert n == len(UNIT.findall(text)) and form != "plain"
    assert fim.rebuild(output, form, fim.Settings()) == text


def test_odd_rows(spark, odd_docs):
    rows = fim.restore(fim.transform(odd_docs)).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        key = "" if r.doc_id is None else r.doc_id
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == by_steps(key, r.text or "")
        assert r.restored == (r.text or "") and r.score == "x"


def test_rate_and_order_of_parts(spark):
    docs = spark.range(2000).selectExpr("id as doc_id", "concat('one two three ', id) as text")
    forms = {r.form: r["count"] for r in fim.transform(docs).groupBy("form").count().collect()}
    assert abs(forms["plain"] - 1000) < 120 and abs(forms["spm"] - 800) < 120 and abs(forms["psm"] - 200) < 70


def test_empty_table(no_docs):
    assert fim.restore(fim.transform(no_docs)).count() == 0


@pytest.mark.parametrize("marks", [("", "b", "c"), ("<P>", "<P>", "<M>"), ("<P", "<P>", "<M>"), ("xa", "ab", "c"), ("aa", "b", "c")])
def test_marks_that_cannot_be_told_apart(marks):
    with pytest.raises(ValueError):
        fim.Settings(prefix=marks[0], suffix=marks[1], middle=marks[2])
