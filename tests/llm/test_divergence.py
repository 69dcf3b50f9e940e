import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsmill.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(docs, min_docs=10, top=10):
    """The contract over rows ``(lang, source, text)``, term by term."""
    docs = [tuple(x or "" for x in row) for row in docs]
    counts, within, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in docs:
        terms = TERM.findall(text.translate(LOWER))
        counts[lang, source].update(terms)
        within[lang].update(set(terms))
        groups[lang].add(source)
    result = set()

    def f(p, q):
        return (p - q) * (p - q) // (p + q)

    for lang, sources in groups.items():
        kept = [t for t, n in within[lang].items() if n >= min_docs]
        total = Counter({t: sum(counts[lang, s][t] for s in sources) for t in kept})

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        q = shares(total)
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                result |= {(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(items)}
    return result


def rows_of(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_docs(seed, n=400, sources=7):
    rng = np.random.default_rng(seed)
    words = [f"{a}{b}" for a in "abcdéz漢" for b in ["", "X", "y", "ß"]]
    docs = []
    for _ in range(n):
        lang = rng.choice(["en", "de", "", None, "xx"], p=[0.5, 0.3, 0.1, 0.05, 0.05])
        source = None if rng.random() < 0.05 else f"s{rng.integers(sources) if rng.random() < 0.6 else 0}"
        own = rng.zipf(1.6, rng.integers(0, 30)) % len(words)
        docs.append((lang, source, None if rng.random() < 0.05 else " 1,".join(words[i] for i in own)))
    return docs


SCHEMA = "lang string, source string, text string"


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_every_term_by_hand(spark, seed, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 9)
    monkeypatch.setattr(divergence, "BLOCK_PER_GROUP", 1)
    monkeypatch.setattr(divergence, "BROADCAST_GROUPS", 0 if seed == 2 else 100)
    docs = random_docs(seed)
    assert rows_of(divergence.audit(spark.createDataFrame(docs, SCHEMA))) == by_hand(docs)


def test_one_word_makes_up_a_source(spark):
    """Shares near the whole: squares beyond what a double holds."""
    docs = [("en", "a", "one " * 5000)] * 12 + [("en", "b", "two " * 7001 + "one")] * 11 + [("en", "c", "one two three")] * 10
    assert rows_of(divergence.audit(spark.createDataFrame(docs, SCHEMA))) == by_hand(docs)


def test_groups_without_terms_and_ties(spark):
    docs = [("en", "a", "x y"), ("en", "b", None), ("en", "c", "1 2 3"), ("fr", "z", "x")]
    docs += [("de", s, "gleich viel") for s in "pqr" for _ in range(4)] + [("de", "leer", "")]
    found = rows_of(divergence.audit(spark.createDataFrame(docs, SCHEMA)))
    assert found == by_hand(docs)
    assert ("en", "a", "pair", "c", 0, 2) in found and ("de", "p", "pair", "leer", 0, 1) in found


def test_held_counts_are_passed_on(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 3)
    docs = random_docs(3, 100)
    schema = spark.createDataFrame(docs, SCHEMA).na.fill("")
    found = divergence._counted(schema).groupBy("source").agg(F.sum("n").alias("n")).collect()
    whole = Counter()
    for _, source, text in docs:
        whole[source or ""] += len(TERM.findall(text or ""))
    assert {r.source: r.n for r in found} == {s: n for s, n in whole.items() if n}


def test_steps_do_not_change_sums(monkeypatch):
    rng = np.random.default_rng(5)
    seen = sorted({(int(t), int(g)) for t, g in zip(rng.integers(0, 9, 60), rng.integers(0, 8, 60), strict=True)})
    term, group = map(np.array, zip(*seen, strict=True))
    zeros = rng.integers(1, 50, 8)
    p, zero = rng.integers(50, 10**9, len(term)), zeros[group]

    def sums():
        return {(u, int(v)): int(s) for u, vs, ss in divergence.row_sums(term, group, p, zero, 8) for v, s in zip(vs, ss, strict=True)}

    whole = sums()
    monkeypatch.setattr(divergence, "STEP", 1)
    assert sums() == whole
    f = divergence.distance
    expected = Counter()
    for i in range(len(term)):
        for j in range(len(term)):
            if term[i] == term[j] and group[i] < group[j]:
                expected[group[i], group[j]] += f(p[i], p[j]) - f(p[i], zero[j]) - f(zero[i], p[j]) + f(zero[i], zero[j])
    assert whole == {k: v for k, v in expected.items() if v}


def test_odd_rows(spark, odd_docs):
    rows = [(r.lang, r.source, r.text) for r in odd_docs.collect()]
    few = divergence.Settings(min_docs=2)
    assert rows_of(divergence.audit(odd_docs, settings=few)) == by_hand(rows, min_docs=2)
    clash = odd_docs.withColumns({"term": F.lit("x"), "n": F.lit("y"), "gid": F.lit(1), "value": F.lit("z")})
    assert rows_of(divergence.audit(clash, settings=few)) == by_hand(rows, min_docs=2)


def test_empty_table(no_docs):
    assert divergence.audit(no_docs).count() == 0
