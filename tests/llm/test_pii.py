import re

import pytest
from pyspark.sql import functions as F

from newsmill.llm import pii

KEY = b"test"


def kinds(text):
    return [(e.kind.split(":")[0], text[e.start : e.end]) for e in pii.find(text)]


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("mail der.55@mail4.example.com.", [("email", "der.55@mail4.example.com")]),
        ("éa@b.org###", [("email", "éa@b.org")]),
        ("call +1 (741) 555-3069, or (741) 555-3069", [("phone", "+1 (741) 555-3069"), ("phone", "(741) 555-3069")]),
        ("card 4111 1111 1111 1111&&&", [("card", "4111 1111 1111 1111")]),
        ("from 196.3.67.149.", [("ip", "196.3.67.149")]),
        ("ssn 123-45-6789", [("ssn", "123-45-6789")]),
        ("IBAN DE89 3704 0044 0532 0130 00", [("iban", "DE89 3704 0044 0532 0130 00")]),
        ("Mrs. Jane Doe met ANNA SCHMIDT", [("given", "Jane"), ("family", "Doe"), ("given", "ANNA"), ("family", "SCHMIDT")]),
        ("версия. Мария Иванова", [("given", "Мария"), ("family", "Иванова")]),
        ("Version 2.0, GPL 3, 999.1.1.1, token ab8ca1b325bc4f85aa6a79e73fc4cbfc2098878e", []),
        ("a@b, @c.org, 12345678", []),
        (None, []),
        ("", []),
    ],
)
def test_find(text, found):
    assert kinds(text) == found


def test_surrogates_keep_the_format():
    s = pii.Surrogates(KEY)
    card = s.of("card", "4111111111111111")
    assert card != "4111111111111111" and card[0] == "4" and pii._luhn(card[:-1]) == int(card[-1])
    iban = s.of("iban", "DE89370400440532013000")
    assert iban[:2] == "DE" and pii._iban_check("DE", iban[4:]) == iban[2:4]
    assert s.of("ip", "192.168.0.9").startswith("192.168.") and s.of("ip", "10.0.0.1").startswith("10.")
    assert re.fullmatch(r"[a-z]{3}\.\d{2}@mail4\.example\.com", s.of("email", "der.55@mail4.example.com"))
    assert s.of("given:latin:f", "Anna") in pii.GIVEN["latin", "f"]
    assert pii.script_of(s.of("family:cyrillic", "Иванова")) == "cyrillic"
    phone = s.of("phone", "+17415553069")
    assert re.sub(r"\D", "", pii.render(phone, "(741) 555-3069", "phone")) == phone[2:]
    assert pii.Surrogates(b"other").of("card", "4111111111111111") != card


@pytest.mark.parametrize("kind", ["card", "ssn", "email"])
def test_formats_are_permuted_one_to_one(kind):
    s = pii.Surrogates(KEY)
    forms = {"card": [f"4{i:015d}" for i in range(3000)], "ssn": [f"1234{i:05d}" for i in range(1, 3000)],
             "email": [f"a{i:04d}@example.com" for i in range(3000)]}[kind]
    assert len({s.of(kind, f) for f in forms}) == len(forms)


def test_documents(spark):
    texts = ["Mr John Smith wrote a@b.org", "john: JOHN SMITH, A@b.org", "nothing here", "a@b.org a@b.org"]
    rows = pii.pseudonymize(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), KEY).orderBy("doc_id").collect()
    first = re.fullmatch(r"Mr (\w+) (\w+) wrote (\S+)", rows[0].text).groups()
    second = re.fullmatch(r"john: (\w+) (\w+), (\S+)", rows[1].text).groups()
    assert [w.upper() for w in first] == [w.upper() for w in second] and first[0] in pii.GIVEN["latin", "m"]
    assert "Smith" not in rows[0].text and "a@b.org" not in rows[0].text
    assert rows[2].text == texts[2] and rows[2].n_replaced == 0
    assert rows[3].text == f"{first[2]} {first[2]}" and rows[3].n_replaced == 2


def test_collisions_draw_again(spark, monkeypatch):
    entities = spark.createDataFrame(
        [("family:latin", "A", "Same", 0), ("family:latin", "B", "Same", 0), ("ip", "1.2.3.4", "1.2.3.4", 0)],
        "kind string, form string, surrogate string, draw int",
    )
    monkeypatch.setattr(pii, "_entities", lambda *a: entities.drop("draw"))
    rows = pii.redrawn(None, KEY).collect()
    assert sorted((r.kind, r.form) for r in rows) == [("family:latin", "B"), ("ip", "1.2.3.4")]


def test_odd_rows(spark, odd_docs, no_docs):
    out = pii.pseudonymize(spark, odd_docs, KEY)
    assert out.columns == [c for c in odd_docs.columns if c != "n_replaced"] + ["n_replaced"]
    assert sorted(map(str, (r.text for r in out.collect()))) == sorted(map(str, (r.text for r in odd_docs.collect())))
    assert out.filter(F.col("n_replaced") > 0).count() == 0
    assert pii.pseudonymize(spark, no_docs, KEY).count() == 0


def test_all_names_and_later_mentions(spark):
    text = "Kennedy? John Fitzgerald Kennedy spoke. Kennedy said that KENNEDY's aunt Maria Lopez left; Maria went, John too, kennedy not."
    names = ["John", "Fitzgerald", "Kennedy", "Kennedy", "KENNEDY", "Maria", "Lopez", "Maria", "John"]
    assert [f for _, f in kinds(text)] == names
    (row,) = pii.pseudonymize(spark, spark.createDataFrame([(1, text)], "doc_id long, text string"), KEY).collect()
    m = re.fullmatch(r"Kennedy\? (\w+) (\w+) (\w+) spoke. (\w+) said that (\w+)'s aunt (\w+) (\w+) left; (\w+) went, (\w+) too, kennedy not.", row.text)
    john, _, family, again, upper, maria, _, maria_again, john_again = m.groups()
    assert family == again and upper == family.upper() and maria == maria_again and john == john_again
    assert not {*names} & {*m.groups()}
