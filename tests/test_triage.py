import json

import pytest
from pyspark.sql import functions as F

from newsmill.operators import triage

CONTENT = "x" * 5000
VALID = {
    "summary": "An RCE vulnerability.",
    "severity": "CRITICAL",
    "relevance_category": "BEDROCK_AGENTCORE",
    "relevance_score": 98,
    "reasoning": "Concerns Agent Core.",
    "affected_products": ["Bedrock", "SDK"],
}
GOOD = json.dumps(VALID)
PARSED = ("parsed", "CRITICAL", "BEDROCK_AGENTCORE", 98, ["Bedrock", "SDK"])
DEFAULTS = ("parsed", "LOW", "OTHER", 0, [])
FALLBACK = ("fallback", "INFO", "OTHER", 0, [])


def but(**changes):
    return json.dumps({**VALID, **changes})


CASES = [
    (GOOD, PARSED),
    (f"```json\n{GOOD}\n```", PARSED),
    (f"```JSON{GOOD}```", PARSED),
    (f"```\n{GOOD}\n\n```", PARSED),
    (f" \n{GOOD}\t ", PARSED),
    (f"```json\n{GOOD}\n```\n", FALLBACK),
    (f"Here: ```json\n{GOOD}\n```", FALLBACK),
    ("not json at all", FALLBACK),
    ("", FALLBACK),
    (GOOD + " trailing", FALLBACK),
    (GOOD + "]", FALLBACK),
    (GOOD + "] trailing", FALLBACK),
    (GOOD + "],[1", FALLBACK),
    (GOOD + "," + GOOD, FALLBACK),
    ("{'severity': 'HIGH'}", FALLBACK),
    ("null", FALLBACK),
    (None, ("missing", None, None, None, None)),
    ("[1]", DEFAULTS),
    ("[]", DEFAULTS),
    ('"s"', DEFAULTS),
    ("3", DEFAULTS),
    ("{}", DEFAULTS),
    (but(relevance_score=150), PARSED[:3] + (100,) + PARSED[4:]),
    (but(relevance_score=-10), PARSED[:3] + (0,) + PARSED[4:]),
    (but(relevance_score=85.5), PARSED[:3] + (86,) + PARSED[4:]),
    (but(relevance_score=85.4), PARSED[:3] + (85,) + PARSED[4:]),
    (but(relevance_score=1e30), PARSED[:3] + (100,) + PARSED[4:]),
    (but(relevance_score="85"), PARSED[:3] + (0,) + PARSED[4:]),
    (but(relevance_score=None), PARSED[:3] + (0,) + PARSED[4:]),
    (but(relevance_score=True), PARSED[:3] + (0,) + PARSED[4:]),
    (but(severity="EXTREME"), ("parsed", "LOW") + PARSED[2:]),
    (but(severity="critical"), ("parsed", "LOW") + PARSED[2:]),
    (but(severity={"a": 1}), ("parsed", "LOW") + PARSED[2:]),
    (but(relevance_category="UNKNOWN"), PARSED[:2] + ("OTHER",) + PARSED[3:]),
    (but(affected_products=["ValidProduct", 42, None, "Another"]), PARSED[:4] + (["ValidProduct", "Another"],)),
    (but(affected_products="none"), PARSED[:4] + ([],)),
    (but(affected_products=None), PARSED[:4] + ([],)),
    (GOOD[:-1] + ', "severity": "HIGH"}', ("parsed", "HIGH") + PARSED[2:]),
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(i, CONTENT, reply) for i, (reply, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "n int, content string, response_text string")
    return {r.n: r for r in triage.parse_replies(df).collect()}


@pytest.mark.parametrize("n", range(len(CASES)))
def test_reply(parsed, n):
    row = parsed[n]
    relevance = row.relevance
    actual = (row.triage_status, row.severity, relevance and relevance.category, relevance and relevance.score,
              row.affected_products)
    assert actual == CASES[n][1], CASES[n][0]
    if row.triage_status == "fallback":
        assert row.summary == CONTENT[:300]
        assert relevance.reasoning == "Failed to parse Bedrock response: " + CASES[n][0][:200]
    if CASES[n][1] == PARSED:
        assert (row.summary, relevance.reasoning) == (VALID["summary"], VALID["reasoning"])


def test_text_fields_must_be_strings(spark):
    df = spark.createDataFrame([("c", '{"summary": 5, "reasoning": ["x"]}')], "content string, response_text string")
    row = triage.parse_replies(df).first()
    assert (row.summary, row.relevance.reasoning) == ("", "")


def article_rows(spark, *rows):
    schema = "id string, title string, content string"
    extra = {"url": "https://e.com", "source": "S", "source_type": "rss"}
    df = spark.createDataFrame(list(rows), schema).withColumns({k: F.lit(v) for k, v in extra.items()})
    return df.withColumn("published_at", F.lit("2026-04-18 08:00:00").cast("timestamp"))


def test_prompt(spark):
    df = triage.build_prompts(article_rows(spark, ("1", "T", "y" * 8000)))
    assert df.first().prompt == (
        "Title: T\nSource: S (rss)\nPublished: 2026-04-18T08:00:00.000Z\nURL: https://e.com\n\nContent:\n" + "y" * 4000
    )


def test_instructions_name_everything():
    for word in ("CRITICAL", "INFO", "BEDROCK_AGENTCORE", "AI_GENERAL", "AWS_SECURITY", "OTHER", "infrastructure software"):
        assert word in triage.INSTRUCTIONS


def test_rules(spark):
    cases = {
        "Bedrock API flaw": "BEDROCK_AGENTCORE",
        "New LLM jailbreak": "AI_GENERAL",
        "IAM privilege escalation": "AWS_SECURITY",
        "Linux kernel bug": "OTHER",
        "Linux on EC2 with IAM": "AWS_SECURITY",
        "Nothing here": "OTHER",
        "Maid service": "OTHER",
    }
    df = article_rows(spark, *((t, t, "") for t in cases))
    rows = triage.triage(df, "rules").collect()
    assert {r.title: r.relevance.category for r in rows} == cases
    zero_day = triage.triage(article_rows(spark, ("1", "t", "a Zero-Day in use")), "rules").first()
    assert zero_day.severity == "CRITICAL"
    with pytest.raises(ValueError):
        triage.triage(df, "model")


def test_scorers(spark):
    articles = article_rows(spark, ("1", "A", "c1"), ("2", "B", "c2"), ("3", "C", "c3"))
    replies = spark.createDataFrame([("1", GOOD), ("2", "junk")], "id string, response_text string")
    by_table = {r.id: r.triage_status for r in triage.triage(articles, replies).collect()}
    assert by_table == {"1": "parsed", "2": "fallback", "3": "missing"}

    def make_scorer():
        def reply(prompts):
            return ['{"summary": "%s", "severity": "HIGH"}' % p.split("\n")[0] for p in prompts]

        return reply

    by_function = {r.id: (r.summary, r.severity) for r in triage.triage(articles, make_scorer).collect()}
    assert by_function["2"] == ("Title: B", "HIGH") and len(by_function) == 3
