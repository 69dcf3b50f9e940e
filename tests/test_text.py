import hashlib

import pytest
from pyspark.sql import functions as F

from newsmill.functions import text


def apply(spark, expression, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in rows.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


STRIP_CASES = {
    "<p>Hello <b>world</b></p>": "Hello world",
    "AT&amp;T &lt;test&gt;": "AT&T <test>",
    "&amp;lt;script&amp;gt;": "&lt;script&gt;",
    "&amp;amp;": "&amp;",
    "  a   b  ": "a b",
    "": "",
    "it&#39;s &#x27;x&#x27; &nbsp;&frac12;": "it s &#x27;x&#x27; &frac12;",
    "&QUOT;q&quot; &LT;&Gt;": '"q" <>',
    "a  b﻿ c\x0b": "a b c",
    "1 < 2 and 3": "1 < 2 and 3",
    "a<br/>b": "a b",
    "&copy;&unknown; x": "x",
}


def test_strip_html(spark):
    assert apply(spark, text.strip_html, STRIP_CASES) == list(STRIP_CASES.values())


def test_strip_html_is_single_pass_for_nested_entities(spark):
    assert apply(spark, text.strip_html, ["&amp;#39;", "&amp;nbsp;", "&lt;b&gt;&amp;quot;"]) == [
        "&#39;",
        "&nbsp;",
        "<b>&quot;",
    ]


def test_article_id(spark):
    url = "https://example.com/test"
    assert apply(spark, text.article_id, [url]) == [hashlib.sha256(url.encode()).hexdigest()]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("http://arxiv.org/abs/2404.01234v1", "https://arxiv.org/abs/2404.01234"),
        (" http://arxiv.org/abs/2404.01234v12\n", "https://arxiv.org/abs/2404.01234"),
        ("https://arxiv.org/abs/2404.01234", "https://arxiv.org/abs/2404.01234"),
        ("http://a/http://b", "https://a/http://b"),
        ("http://arxiv.org/abs/v2/x", "https://arxiv.org/abs/v2/x"),
    ],
)
def test_paper_url(spark, raw, expected):
    assert apply(spark, text.paper_url, [raw]) == [expected]


def test_collapse_and_trim(spark):
    assert apply(spark, text.collapse_whitespace, ["a\n  b c \t"]) == ["a b c"]
    assert apply(spark, text.trim_unicode, ["　 a b\n"]) == ["a b"]


def test_escape_markup(spark):
    assert apply(spark, text.escape_markup, ['<a href="x">&</a>']) == ["&lt;a href=&quot;x&quot;&gt;&amp;&lt;/a&gt;"]


def test_ordinal_sorts_like_its_parts(spark):
    parts = [(0, 5), (0, 2**40), (1, 0), (3, 7), (7, 2**59)]
    rows = spark.createDataFrame(parts, "source_ord int, pos bigint")
    values = [r.o for r in rows.select(text.ordinal().alias("o"), "source_ord", "pos").orderBy("source_ord", "pos").collect()]
    assert values == sorted(values) and len(set(values)) == len(parts)
