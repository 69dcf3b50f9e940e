"""Secrets in texts: loose candidates, then a random forest that removes false positives.

A candidate is a long run of token characters with a digit, or any value of some
length that is assigned to a secret's name. Its features are its length, the changes between kinds of characters in it, how much of it is words of
the corpus, its path and the words around it. The forest learns from labelled
findings. All of it is DataFrame functions and Spark's own forest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.functions.binding import once
from newsmill.session import materialize

# What names a secret, and what a path or neighbour says of examples.
SECRET_NAMES = "secret|token|passwd|password|pwd|api[_-]?key|access[_-]?key|private[_-]?key|credential|bearer|auth"
EXAMPLE_NAMES = "example|sample|test|mock|dummy|fixture|placeholder|changeme|todo|demo"
# Formats that issuers give their keys, and formats of values that are no secrets: identifiers and dates.
ISSUED = (
    r"^((AKIA|ASIA)[0-9A-Z]{16}|gh[opsur]_[A-Za-z0-9]{36,}|github_pat_\w{22,}|glpat-[\w\-]{20,}|xox[abprs]-[\w\-]{10,}"
    r"|[rs]k_live_[A-Za-z0-9]{16,}|AIza[\w\-]{35}|npm_[A-Za-z0-9]{36}|eyJ[\w\-]+\.eyJ[\w\-]+\.[\w\-]+)"
)
PLAIN = r"^([0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$|[0-9]{4}-[0-9]{2}-[0-9]{2}([T_]|$))"
# End of fixed values.

#: A candidate: so many token characters, one of them a digit.
CANDIDATE = r"(?=[A-Za-z+/_\-]*[0-9])[A-Za-z0-9+/_\-]{12,}={0,2}"
MIN_LENGTH = 12
#: A value assigned to a secret's name: so many characters that are neither white space nor delimiters, digits or not.
NAMED_LENGTH = 6
#: Stands before a named value while a text is cut into words.
MARK = "\x01"
DELIMITERS = r"\s\"'`,;&<>(){}\[\]"
LAST = r"[A-Za-z0-9+/_\-=!$%*#@?]"
VALUE = rf"[^{DELIMITERS}]{{{NAMED_LENGTH - 1},}}{LAST}"
NAMED = rf"(?i)((?:{SECRET_NAMES})[\"'`\]]{{0,2}}\s{{0,3}}(?:=>?|:=?)\s{{0,3}}[\"'`]?|bearer\s{{1,3}})(?={VALUE})"
#: What is searched in a word of a marked text: a value ends before the next mark.
FOUND = rf"(?<={MARK})[^{DELIMITERS}{MARK}]{{{NAMED_LENGTH - 1},}}{LAST}|{CANDIDATE}"
#: Words in this part of the distinct texts, and in two at least, are words of the dictionary.
DICTIONARY_PART = 1e-4
#: Distinct letter runs of the candidates up to this number are broadcast (20 bytes or so each).
BROADCAST_ROWS = 200_000

FEATURES = (
    "length", "runs", "digit_part", "upper_part", "mark_part", "hex_only", "digits_only", "distinct_part", "covered_part",
    "assigned", "quoted", "secret_name", "example_name", "path_depth", "path_example", "after_plain",
)


@dataclass(frozen=True)
class Settings:
    """``rows_per_class`` bounds the labelled findings to learn from, by a hash of their place."""

    rows_per_class: int = 5000
    trees: int = 20
    depth: int = 6
    threshold: float = 0.5
    seed: int = 7


def _part(text: Column, pattern: str) -> Column:
    """The part of the characters that match."""
    return F.char_length(F.regexp_replace(text, f"[^{pattern}]", "")) / F.char_length(text)


def _marked(text: Column) -> Column:
    """``text`` with ``MARK`` before each value that is assigned to a secret's name."""
    return F.regexp_replace(F.translate(text, MARK, "\ufffd"), NAMED, f"$1{MARK}")


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """One row per candidate: ``key``, ``place`` (of its word), ``ordinal`` (in it), ``finding``, its surroundings and ``path``.

    Whole texts are searched; null and empty texts have none.
    """
    words = F.split("body", r"[\x20\x09-\x0D]+")

    def found(words: Column) -> Column:
        def long_enough(i: Column) -> Column:
            word = F.get(words, i)
            return F.contains(word, F.lit(MARK)) | ((F.octet_length(word) >= MIN_LENGTH) & word.rlike(CANDIDATE))

        def row(i: Column) -> Column:
            before = [F.coalesce(F.get(words, i - j), F.lit("")) for j in (3, 2, 1)]
            return F.struct(
                i.alias("place"),
                F.get(words, i).alias("word"),
                F.array_join(F.array(*before), " ").alias("before"),
                F.coalesce(F.get(words, i + 1), F.lit("")).alias("after"),
            )

        return F.transform(F.filter(F.sequence(F.lit(0), F.size(words) - 1), long_enough), row)

    body = F.col(f"`{text}`")
    rows = docs.filter(body.rlike(f"{CANDIDATE}|{NAMED}")).select(
        F.col(f"`{key}`").alias("key"),
        F.coalesce(F.col(f"`{path}`").cast("string"), F.lit("")).alias("path"),
        _marked(body).alias("body"),
    )
    rows = rows.select("key", "path", F.explode(once(words, found)).alias("c")).select("key", "path", "c.*")
    # All candidates of a word and the texts between them, found once.
    matches = F.regexp_extract_all("word", F.lit(FOUND), F.lit(0))
    parts = F.struct(matches.alias("found"), F.split("word", FOUND, -1).alias("between"))

    def each(p: Column) -> Column:
        last = F.size(p["found"]) - 1

        def row(i: Column) -> Column:
            between = F.get(p["between"], i)
            return F.struct(
                i.alias("ordinal"),
                F.get(p["found"], i).alias("finding"),
                F.when(i == 0, F.concat_ws(" ", "before", between)).otherwise(between).alias("before"),
                F.when(i == last, F.col("after")).otherwise(F.get(p["between"], i + 1)).alias("after"),
            )

        return F.transform(F.sequence(F.lit(0), last), row)

    rows = rows.select("key", "path", "place", F.explode(once(parts, each)).alias("c"))
    around = [F.translate(F.col(f"c.{side}"), MARK, "").alias(side) for side in ("before", "after")]
    return rows.select("key", "path", "place", "c.ordinal", "c.finding", *around)


def _coverage(found: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """``(finding, covered_part)``: the part of each candidate that is words of the corpus.

    A word counts once for each distinct text where it stands by itself outside candidates.
    """
    runs = F.filter(F.split(F.lower("finding"), "[^a-z]+"), lambda r: F.length(r) >= 3)
    parts = found.select("finding").distinct().select("finding", F.posexplode(runs).alias("at", "run"))
    wanted = materialize(parts.select("run").distinct(), "secret-runs")
    small = wanted.count() <= BROADCAST_ROWS
    body = F.col(f"`{text}`")
    texts = docs.filter(body.isNotNull()).select(F.xxhash64(body.cast("binary")).alias("of"), body.alias("body"))
    n_texts = texts.select("of").distinct().count()
    alone = F.array_distinct(F.split(F.lower(F.regexp_replace(_marked(F.col("body")), FOUND, " ")), "[^a-z0-9]+"))
    words = texts.select("of", F.explode(alone).alias("run"))
    words = words.join(F.broadcast(wanted) if small else wanted, "run", "left_semi").distinct()
    least = max(2, DICTIONARY_PART * n_texts)
    known = words.groupBy("run").count().filter(F.col("count") >= least).select("run")
    known = materialize(known, "secret-words")
    covered = parts.join(known, "run").groupBy("finding").agg(F.sum(F.length("run")).alias("covered"))
    return covered.select("finding", (F.col("covered") / F.length("finding")).alias("covered_part"))


def features(found: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """``found`` with a column of numbers for each of ``FEATURES``."""
    kinds = F.translate("finding", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A" * 26)
    kinds = F.translate(F.translate(kinds, "bcdefghijklmnopqrstuvwxyz", "a" * 25), "123456789", "0" * 9)
    both = found.join(_coverage(found, docs, text), "finding", "left")
    name = F.lower("before")
    columns = {
        "length": F.char_length("finding"),
        "runs": (F.char_length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1) / F.char_length("finding"),
        "digit_part": _part(F.col("finding"), "0-9"),
        "upper_part": _part(F.col("finding"), "A-Z"),
        "mark_part": _part(F.col("finding"), r"+/_\-="),
        "hex_only": F.col("finding").rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        "digits_only": F.col("finding").rlike("^[0-9]+$"),
        "distinct_part": F.size(F.array_distinct(F.split("finding", ""))) / F.char_length("finding"),
        "covered_part": F.coalesce("covered_part", F.lit(0.0)),
        "assigned": F.col("before").rlike(r"([=:]>?\s*[\"'`]?|(?i:bearer)\s+)$"),
        "quoted": F.col("before").rlike(r"[\"'`]$"),
        "secret_name": name.rlike(rf"({SECRET_NAMES})[\"'`\]]{{0,2}}\s*[=:>]{{0,2}}\s*[\"'`]?$"),
        "example_name": name.rlike(EXAMPLE_NAMES),
        "path_depth": F.size(F.split("path", "/")),
        "path_example": F.lower("path").rlike(EXAMPLE_NAMES),
        "after_plain": F.col("after").rlike(r"^[\p{L}]+[.,;]?$"),
    }
    numbers = [columns[c].cast("double").alias(c) for c in FEATURES]
    return both.select("key", "path", "place", "ordinal", "finding", "before", *numbers)


def evidence_labels(described: DataFrame) -> DataFrame:
    """Findings that something outside their features tells about.

    Secrets have an issuer's format, or another document assigns the value to a
    secret's name. No secrets are numbers with a right check digit, identifiers,
    dates, and values of several documents that none of them assigns so.
    """
    named = (F.col("secret_name") == 1) & (F.col("assigned") == 1) & (F.col("example_name") + F.col("path_example") == 0)
    by = F.when(named, F.col("key"))
    ends = [F.min("key").alias("first"), F.max("key").alias("last"), F.min(by).alias("first_named"), F.max(by).alias("last_named")]
    both = described.join(described.groupBy("finding").agg(*ends), "finding")
    elsewhere = (F.col("first_named") != F.col("key")) | (F.col("last_named") != F.col("key"))
    value = F.col("finding")
    plain = value.rlike(PLAIN) | (value.rlike("^[0-9]{13,19}$") & F.expr("luhn_check(finding)"))
    label = F.when(value.rlike(ISSUED), 1.0).when(plain, 0.0).when(elsewhere, 1.0)
    label = label.when(F.col("first_named").isNull() & (F.col("first") != F.col("last")), 0.0)
    return both.withColumn("label", label).filter(F.col("label").isNotNull()).select(*described.columns, "label")


def rule_labels(described: DataFrame) -> DataFrame:
    """Findings labelled by a strict rule, for lack of better labels.

    A secret is a value assigned to a secret's name, not in an example, that is no
    plain number and hardly words. It is no secret if nothing names it.
    """
    yes = (F.col("secret_name") == 1) & (F.col("assigned") == 1) & (F.col("digits_only") == 0)
    yes = yes & (F.col("covered_part") < 0.5) & (F.col("example_name") + F.col("path_example") == 0)
    no = (F.col("secret_name") == 0) | (F.col("digits_only") == 1) | (F.col("covered_part") >= 0.5)
    label = F.when(yes, 1.0).when(no, 0.0)
    return described.withColumn("label", label).filter(F.col("label").isNotNull())


def train(labelled: DataFrame, settings: Settings = Settings()):
    """A forest of ``labelled`` findings (``FEATURES`` and ``label`` 0 or 1), or None if only one label occurs."""
    counts = {r.label: r.n for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two labels
    if len(counts) < 2:
        return None
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, settings.rows_per_class / n).otherwise(share)
    place = F.pmod(F.xxhash64(F.col("key").cast("string"), "place"), F.lit(1 << 20)) / float(1 << 20)
    rows = labelled.filter(place < share).select(*FEATURES, "label")
    # A bounded sample, in one order, so that every run grows the same trees.
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows.orderBy(*FEATURES, "label").coalesce(1))
    forest = RandomForestClassifier(numTrees=settings.trees, maxDepth=settings.depth, seed=settings.seed)
    return forest.fit(materialize(rows.select("features", "label"), "secret-labels"))


def scan(docs: DataFrame, labelled: DataFrame | None = None, key: str = "doc_id", text: str = "text", path: str = "source",
         learn_from: Column | None = None, settings: Settings = Settings()) -> DataFrame:
    """One row per candidate: key, ``place``, ``ordinal``, ``finding``, ``score`` (0 to 1) and ``is_secret``.

    ``labelled`` has rows ``(key, place, label)`` that name findings of ``docs``, with
    ``ordinal`` if not the first ones of their words. Without it ``evidence_labels`` labels
    them, and a strict rule gives the rows of a class that has no evidence. ``learn_from``
    (on the column ``key``) restricts what is learnt from. If the labels do not have both
    classes, the rule alone decides. Repeated rows give their findings again; an empty
    table, null and empty texts give none; a null path is an empty one.
    """
    found = materialize(candidates(docs, key, text, path), "secret-candidates")
    described = materialize(features(found, docs, text), "secret-features")
    if labelled is None:
        known = evidence_labels(described)
        usable = known if learn_from is None else known.filter(learn_from)
        have = [r.label for r in usable.select("label").distinct().collect()]  # two labels
        if len(have) < 2:
            known = known.unionByName(rule_labels(described).filter(~F.col("label").isin(have)))
    else:
        ordinal = F.col("ordinal") if "ordinal" in labelled.columns else F.lit(0)
        marks = labelled.select("key", "place", ordinal.alias("ordinal"), F.col("label").cast("double").alias("label"))
        known = described.join(marks.dropDuplicates(["key", "place", "ordinal"]), ["key", "place", "ordinal"])
    model = train(known if learn_from is None else known.filter(learn_from), settings)
    if model is None:
        own = ["key", "place", "ordinal", "finding"]
        rule = rule_labels(described).select(*own, F.col("label").alias("score"))
        scored = described.select(*own).join(rule, own, "left").fillna(0.0, ["score"])
    else:
        ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(described)
        scored = model.transform(ready).withColumn("score", vector_to_array("probability")[1])
    return scored.select(
        F.col("key").alias(key), "place", "ordinal", "finding", "score", (F.col("score") >= settings.threshold).alias("is_secret")
    )
