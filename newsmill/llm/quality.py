"""Quality verdicts: base rules, then a calibrated classifier on hashed n-grams.

The classifier is a logistic regression on hashed word and character n-grams of
the whole text, learnt from labelled rows; a second regression on rows that the
first has not seen turns its margins into probabilities. Texts are scored in
Arrow batches against fixed thresholds.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.llm.common import WordHashes, arrow_columns, gram_hashes, list_array, mix
from newsmill.session import materialize

SYMBOLS = re.compile(r"[#*$%&|<>]")
#: The ASCII white space that ends a word, and no other.
SPACE = re.compile(r"[\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Settings:
    """``rows_per_class`` bounds the labelled rows to learn from, by a hash of their
    key; ``bits`` is the size of the hashed space; ``threshold`` is the least
    probability of good quality that keeps a text."""

    rows_per_class: int = 4000
    bits: int = 16
    word_sizes: tuple[int, ...] = (1, 2)
    char_sizes: tuple[int, ...] = (3,)
    penalty: float = 1e-3
    threshold: float = 0.5
    min_words: int = 50
    max_repeat_percent: int = 50


# --- base rules ---------------------------------------------------------------


def base_numbers(text: str | None, hashes: WordHashes) -> tuple[int, int, int, int, int]:
    """Words, code points in them, symbols, repeated lines, words in repeated 3-word windows."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()
    chars = len(text) - sum(map(text.count, "\x20\x09\x0a\x0b\x0c\x0d"))
    lines = [line for line in text.split("\n") if not SPACE.fullmatch(line) and line]
    repeated = len(lines) - len(set(lines))
    grams = gram_hashes(hashes.of(words), 3)
    inside = np.zeros(len(words) + 1, np.int64)
    if len(grams):
        _, back, counts = np.unique(grams, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(counts[back] > 1)
        np.add.at(inside, starts, 1)
        np.add.at(inside, np.minimum(starts + 3, len(words)), -1)
    return len(words), chars, len(SYMBOLS.findall(text)), repeated, int((np.cumsum(inside)[: len(words)] > 0).sum())


# --- features --------------------------------------------------------------------


class Features:
    """Hashed n-gram features of texts: the places and weights of a unit vector."""

    def __init__(self, settings: Settings):
        self.settings = settings
        self.words = WordHashes(xxhash.xxh3_64_intdigest)
        self.size = 1 << settings.bits

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Each kind of n-gram has half of the length; weights are square roots of shares."""
        if not text:
            return np.empty(0, np.int32), np.empty(0)
        data = text.encode()
        words = self.words.of(data.split())
        letters = mix(np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64))
        kinds = [(words, n, 1) for n in self.settings.word_sizes] + [(letters, n, 2) for n in self.settings.char_sizes]
        total = np.zeros(self.size)
        for series, n, kind in kinds:
            grams = gram_hashes(series, n)
            if len(grams):
                places = (mix(grams + np.uint64(16 * kind + n)) >> np.uint64(64 - self.settings.bits)).astype(np.int64)
                total += np.bincount(places, minlength=self.size) / (len(grams) * len(kinds))
        places = np.flatnonzero(total)
        return places.astype(np.int32), np.sqrt(total[places])


def _hashed(rows: DataFrame, settings: Settings) -> DataFrame:
    def make():
        features = Features(settings)

        def apply(texts: pa.Array):
            found = [features.of(t.as_py()) for t in texts]
            return [
                list_array([f[0] for f in found], "int32", pa.int32()),
                list_array([f[1] for f in found], "float64", pa.float64()),
            ]

        return apply

    return arrow_columns(rows, ["text"], "places array<int>, weights array<double>", make, keep=["label", "part"])


# --- learning ------------------------------------------------------------------


def sample(marks: DataFrame, settings: Settings) -> DataFrame:
    """About ``rows_per_class`` rows ``(key, label, part)`` of each label at most.

    The rows are the same in every run, and so is their ``part``, 0 to 3.
    """
    share = F.lit(0.0)
    for row in marks.groupBy("label").agg(F.count("*").alias("n")).collect():  # two labels
        share = F.when(F.col("label") == row.label, settings.rows_per_class / row.n).otherwise(share)
    key = F.col("key").cast("string")
    place = F.pmod(F.xxhash64(key, F.lit(29)), F.lit(1 << 20)) / float(1 << 20)
    part = F.pmod(F.xxhash64(key, F.lit(31)), F.lit(4))
    return marks.filter(place < share).select("key", "label", part.alias("part"))


@dataclass(frozen=True)
class Model:
    """Weights of the hashed space, and the line that calibrates a margin."""

    weights: np.ndarray
    intercept: float
    slope: float
    shift: float

    def probability(self, places: np.ndarray, weights: np.ndarray) -> float:
        margin = float(self.weights[places] @ weights) + self.intercept
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -700, 700))))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text",
          label: str = "quality") -> Model:
    """A model of the rows of ``docs`` that ``labels`` marks 0 or 1.

    Rows with a null key, text or label, or another label, teach nothing; of
    labels that repeat a key the largest counts. With fewer than two classes the
    model gives every text the probability of the one class there is, or 1.
    """
    marks = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).filter("label in (0, 1) and key is not null")
    marks = marks.groupBy("key").agg(F.max("label").alias("label"))
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    chosen = materialize(sample(marks, settings), "quality-labels")  # bounded by ``rows_per_class``
    rows = texts.join(F.broadcast(chosen), "key").select("text", "label", "part")
    rows = materialize(_hashed(rows, settings), "quality-features")
    size = 1 << settings.bits
    vector = F.udf(lambda p, w: SparseVector(size, p, w), VectorUDT())
    # Vectors are made once: the iterations of the fit read them.
    rows = rows.select(F.col("label").cast("double").alias("label"), "part", vector("places", "weights").alias("features"))
    rows = materialize(rows, "quality-vectors")
    learnt, held = rows.filter("part > 0"), rows.filter("part = 0")
    seen = {r.label for r in learnt.select("label").distinct().collect()}  # two labels
    if len(seen) < 2:
        return Model(np.zeros(size), 0.0, 0.0, 700.0 if seen != {0.0} else -700.0)
    fit = LogisticRegression(regParam=settings.penalty, maxIter=60).fit(learnt)
    weights, intercept = fit.coefficients.toArray(), float(fit.intercept)
    margins = fit.transform(held).select("label", vector_to_array("rawPrediction")[1].alias("value"))
    margins = materialize(VectorAssembler(inputCols=["value"], outputCol="margin").transform(margins), "quality-margins")
    if margins.select("label").distinct().count() < 2:
        return Model(weights, intercept, 1.0, 0.0)
    line = LogisticRegression(featuresCol="margin", regParam=1e-3, maxIter=60).fit(margins)
    return Model(weights, intercept, float(line.coefficients[0]), float(line.intercept))


# --- verdicts -----------------------------------------------------------------------

OUTPUTS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, quality double"
)


def judge(spark: SparkSession, docs: DataFrame, model: Model, settings: Settings = Settings(), text: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the base numbers, ``base_failed``, ``kept`` and the probability ``quality``.

    Null and empty texts have no words, so the base rules fail them. Equal texts
    get equal verdicts. Input columns of these names are replaced.
    """
    sent = spark.sparkContext.broadcast(model)

    def make():
        features, learnt = Features(settings), sent.value
        hashes = features.words

        def one(body: str | None) -> tuple:
            numbers = base_numbers(body, hashes)
            failed = numbers[0] < settings.min_words or 100 * numbers[4] > settings.max_repeat_percent * numbers[0]
            quality = learnt.probability(*features.of(body))
            return *numbers, failed, not failed and quality >= settings.threshold, quality

        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]

        def apply(texts: pa.Array):
            rows = [one(t.as_py()) for t in texts]
            return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]

        return apply

    return arrow_columns(docs, [text], OUTPUTS, make, keep)
