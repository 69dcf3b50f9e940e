"""Triage: prompts, scorers, and parsing and repair of their replies."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.functions.binding import once
from newsmill.functions.dates import iso_millis
from newsmill.functions.text import WHITESPACE, trim_unicode
from newsmill.operators.policy import CATEGORY_NAMES, SEVERITY_NAMES
from newsmill.session import configure

# Lengths and text that replies and fallbacks must carry.
PROMPT_CONTENT_CHARS = 4000
FALLBACK_SUMMARY_CHARS = 300
FALLBACK_REPLY_CHARS = 200
FALLBACK_REASON = "Failed to parse Bedrock response: "

INSTRUCTIONS = """Act as a security analyst and rate one article for a daily briefing.

Categories:
BEDROCK_AGENTCORE: the article concerns Bedrock or Agent Core directly.
AI_GENERAL: attacks on or research about AI models and AI frameworks.
AWS_SECURITY: another AWS security matter; a specific service must be named.
OTHER: everything else. A flaw in infrastructure software such as an operating
system, web server, crypto library or language runtime belongs here unless the
article names a specific AWS service.

Severities: CRITICAL for active exploitation or a zero-day, HIGH for a serious
unpatched flaw or working exploit, MEDIUM for patched or theoretical attacks,
LOW for minor updates, INFO for news without a security consequence.

Answer with one JSON object and nothing else. Its fields are summary (two or
three sentences), severity, relevance_category, relevance_score (0 to 100),
reasoning (one sentence) and affected_products (an array of names)."""

# Terms of the written triage rules.
BEDROCK_TERMS = ("bedrock", "agent core", "agentcore")
AI_TERMS = (
    "llm", "large language model", "jailbreak", "prompt injection", "model poisoning",
    "adversarial", "ai", "pytorch", "tensorflow", "langchain",
)
CLOUD_SERVICE_TERMS = (
    "iam", "s3", "lambda", "ec2", "cloudformation", "sagemaker", "kms", "vpc", "ecs", "eks",
)
INFRASTRUCTURE_TERMS = ("linux", "openssl", "apache", "nginx", "python", "node.js", "docker")
SEVERITY_TERMS = (
    ("CRITICAL", ("active exploitation", "actively exploited", "zero-day")),
    ("HIGH", ("unpatched", "proof of concept", "poc", "exploit")),
    ("MEDIUM", ("patched", "theoretical", "vulnerability", "attack")),
    ("LOW", ("update", "minor", "security")),
)


def _head(text: Column | str, chars: int | None) -> Column:
    """The first ``chars`` characters, or all of them for None."""
    whole = F.col(text) if isinstance(text, str) else text
    return whole if chars is None else F.substring(whole, 1, chars)


def build_prompt(content_chars: int | None = PROMPT_CONTENT_CHARS) -> Column:
    """User message of an article; content is cut to what a model call takes, None keeps it whole."""
    return F.concat(
        F.lit("Title: "), "title",
        F.lit("\nSource: "), "source", F.lit(" ("), "source_type", F.lit(")"),
        F.lit("\nPublished: "), iso_millis(F.col("published_at")),
        F.lit("\nURL: "), "url",
        F.lit("\n\nContent:\n"), _head("content", content_chars),
    )


def build_prompts(articles: DataFrame, content_chars: int | None = PROMPT_CONTENT_CHARS) -> DataFrame:
    return articles.withColumn("prompt", build_prompt(content_chars))


def _json_value(text: Column) -> Column:
    """The JSON value that is the whole of ``text``, else NULL.

    ``try_parse_json`` ignores what follows the first value. Wrapping the text
    in an array that ends with a marker no reply can predict makes leftovers
    visible: only a single complete value gives two elements.
    """

    def whole(value: Column, marker: Column) -> Column:
        complete = (F.try_variant_get(value, "$[1]", "string") == marker) & F.try_variant_get(
            value, "$[2]", "variant"
        ).isNull()
        return F.when(complete, F.try_variant_get(value, "$[0]", "variant"))

    def parse(t: Column) -> Column:
        marker = F.xxhash64(t).cast("string")
        wrapped = F.try_parse_json(F.concat(F.lit("["), t, F.lit(',"'), marker, F.lit('"]')))
        return once(wrapped, lambda value: whole(value, marker))

    return once(text, parse)


def _strip_fence(text: Column) -> Column:
    text = F.regexp_replace(text, rf"(?i)\A```(?:json)?{WHITESPACE}*+", "")
    return trim_unicode(F.regexp_replace(text, rf"(?<!{WHITESPACE}){WHITESPACE}*+```\z", ""))


def parse_replies(df: DataFrame, summary_chars: int | None = FALLBACK_SUMMARY_CHARS,
                  reply_chars: int | None = FALLBACK_REPLY_CHARS) -> DataFrame:
    """Turn ``response_text`` into summary, severity, relevance and products.

    A reply that cannot be read is replaced by the first ``summary_chars`` of the
    content and quoted by its first ``reply_chars``; None takes all of either.

    ``triage_status`` is ``parsed``, ``fallback`` (no JSON in the reply) or
    ``missing`` (no reply; such rows belong in quarantine).
    """
    configure(df.sparkSession)
    reply = F.col("response_text")

    def field(name: str) -> Column:
        return F.try_variant_get("_reply", f"$.{name}", "variant")

    def text_field(name: str) -> Column:
        return F.when(F.schema_of_variant(field(name)) == "STRING", field(name).cast("string"))

    def known(value: Column, names: tuple[str, ...], default: str) -> Column:
        return F.when(value.isin(*names), value).otherwise(F.lit(default))

    score = F.when(
        F.schema_of_variant(field("relevance_score")).rlike(r"\A(?:BIGINT|DOUBLE|DECIMAL)"),
        F.try_variant_get("_reply", "$.relevance_score", "double"),
    )
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.coalesce(score, F.lit(0.0))))
    score = F.floor(clamped + 0.5).cast("int")
    products = F.coalesce(
        F.transform(
            F.filter(
                F.try_variant_get("_reply", "$.affected_products", "array<variant>"),
                lambda x: F.schema_of_variant(x) == "STRING",
            ),
            lambda x: x.cast("string"),
        ),
        F.array().cast("array<string>"),
    )
    parsed = F.struct(
        F.coalesce(text_field("summary"), F.lit("")).alias("summary"),
        known(text_field("severity"), SEVERITY_NAMES, "LOW").alias("severity"),
        F.struct(
            known(text_field("relevance_category"), CATEGORY_NAMES, "OTHER").alias("category"),
            score.alias("score"),
            F.coalesce(text_field("reasoning"), F.lit("")).alias("reasoning"),
        ).alias("relevance"),
        products.alias("affected_products"),
    )
    fallback = F.struct(
        _head("content", summary_chars).alias("summary"),
        F.lit("INFO").alias("severity"),
        F.struct(
            F.lit("OTHER").alias("category"),
            F.lit(0).alias("score"),
            F.concat(F.lit(FALLBACK_REASON), _head(reply, reply_chars)).alias("reasoning"),
        ).alias("relevance"),
        F.array().cast("array<string>").alias("affected_products"),
    )
    readable = F.col("_reply").isNotNull() & ~F.is_variant_null("_reply")
    return (
        df.withColumn("_reply", _json_value(_strip_fence(reply)))
        .withColumn("triage_status", F.when(reply.isNull(), "missing").when(readable, "parsed").otherwise("fallback"))
        .withColumn(
            "_triage",
            F.when(F.col("triage_status") == "parsed", parsed).when(F.col("triage_status") == "fallback", fallback),
        )
        .select(*[c for c in df.columns if c != "response_text"], "_triage.*", "triage_status")
    )


def attach_replies(articles: DataFrame, responses: DataFrame) -> DataFrame:
    """Left join of articles to replies by id; of several replies to an id the one that sorts first counts."""
    one = responses.groupBy("id").agg(F.min("response_text").alias("response_text"))
    return articles.join(one, "id", "left")


#: What separates the words of the rules' terms; all else in a text does so as well.
_APART = r"[^a-z0-9]+"


def _words(text: Column) -> Column:
    return F.split(text, _APART)


def mentions(term_sets: Mapping[str, Sequence[str]], text: Column | str = "text") -> Column:
    """Names of the sets of which a term occurs in ``text`` (lower case) as whole words: array<string>.

    The text is cut into words once. A term of one word is looked up among them, all terms
    of a set at a time; one of several words is searched only where its words are there,
    with the characters between them as they are written.
    """
    whole = F.col(text) if isinstance(text, str) else text

    def found(words: Column) -> Column:
        names = []
        for name, terms in term_sets.items():
            single = [t for t in terms if re.fullmatch("[a-z0-9]+", t)]
            hit = F.arrays_overlap(words, F.array(*map(F.lit, single))) if single else F.lit(False)
            for term in (t for t in terms if t not in single):
                longest = max(re.split(_APART, term), key=len)
                pattern = rf"(?:^|[^a-z0-9]){re.escape(term)}(?:[^a-z0-9]|$)"
                hit = hit | (F.array_contains(words, longest) & F.contains(whole, F.lit(term)) & whole.rlike(pattern))
            names.append(F.when(hit, F.lit(name)))
        return F.array_compact(F.array(*names))

    return once(_words(whole), found)


def rule_triage(articles: DataFrame) -> DataFrame:
    """Triage by the written rules alone; a baseline, not equal to a model."""
    sets = {
        "bedrock": BEDROCK_TERMS, "ai": AI_TERMS, "cloud": CLOUD_SERVICE_TERMS, "infrastructure": INFRASTRUCTURE_TERMS, **dict(SEVERITY_TERMS),
    }

    def mentioned(name: str) -> Column:
        return F.array_contains("_mentions", name)

    category = (
        F.when(mentioned("bedrock"), "BEDROCK_AGENTCORE")
        .when(mentioned("ai"), "AI_GENERAL")
        .when(mentioned("infrastructure") & ~mentioned("cloud"), "OTHER")
        .when(mentioned("cloud"), "AWS_SECURITY")
        .otherwise("OTHER")
    )
    severity = F.lit("INFO")
    for name, _ in reversed(SEVERITY_TERMS):
        severity = F.when(mentioned(name), name).otherwise(severity)
    score = F.when(F.col("relevance_category") == "OTHER", 0).otherwise(60)
    text = F.lower(F.concat_ws(" ", "title", "content"))
    return (
        articles.withColumn("_mentions", once(text, lambda t: mentions(sets, t)))
        .withColumn("relevance_category", category)
        .select(
            *articles.columns,
            F.col("title").alias("summary"),
            severity.alias("severity"),
            F.struct(
                F.col("relevance_category").alias("category"),
                score.alias("score"),
                F.lit("rules").alias("reasoning"),
            ).alias("relevance"),
            F.array().cast("array<string>").alias("affected_products"),
            F.lit("parsed").alias("triage_status"),
        )
    )


ReplyFunction = Callable[[list[str]], list[str]]


def score_with(articles: DataFrame, make_scorer: Callable[[], ReplyFunction], instructions: str | None = None,
               content_chars: int | None = PROMPT_CONTENT_CHARS) -> DataFrame:
    """Add ``response_text`` by a user function over batches of prompts.

    ``instructions`` (such as ``INSTRUCTIONS``) come before every prompt, for
    models that take no separate system message.

    ``make_scorer`` runs once per task, so a client is built once and reused.
    Only the prompt crosses to Python. Write the result to a table before
    using it twice: a lost executor then costs its own partitions only.
    """

    prompt = build_prompt(content_chars)
    if instructions is not None:
        prompt = F.concat(F.lit(f"{instructions}\n\n"), prompt)

    @F.pandas_udf("string")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reply = make_scorer()
        for prompts in batches:
            yield pd.Series(reply(prompts.tolist()), dtype="object")

    return articles.withColumn("response_text", call.asNondeterministic()(prompt))


def triage(articles: DataFrame, scorer: DataFrame | Callable[[], ReplyFunction] | str) -> DataFrame:
    """Triage by a table of replies, a user function, or ``"rules"``."""
    if isinstance(scorer, str):
        if scorer != "rules":
            raise ValueError(f"unknown scorer {scorer!r}")
        return rule_triage(articles)
    if callable(scorer):
        return parse_replies(score_with(articles, scorer))
    return parse_replies(attach_replies(articles, scorer))
