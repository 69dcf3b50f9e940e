"""Language identification by words, backing off to character n-grams.

A word that the model knows is scored by its log frequency in each language. For
an unseen word the n-grams of the padded word are tried, longest first; the first
length with a known n-gram gives the mean of their log frequencies. A language
that lacks a known item pays a fixed penalty. A text's score in a language is the
mean over its words; words of which nothing is known but the space around them say
nothing. How much of a text is known at all is measured apart from that.
"""

from __future__ import annotations

import math
import unicodedata
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsmill.llm.common import arrow_columns, free_name

UNKNOWN = "und"
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Languages beyond this are refused, because a table of them is sent to tasks.
MAX_LANGS = 1000
#: Extra cost, in powers of ten, beyond that of an item seen once in a language.
PENALTY = 1.0
#: Known part of an accepted text at least. Of 1,500 held-out rows of the given texts the
#: least had 0.90, of 300 texts of random Latin letters the most had 0.19.
MIN_KNOWN = 0.4


@dataclass(frozen=True)
class Settings:
    """``rows_per_lang`` bounds the rows to learn from, by a hash of their key;
    ``max_items``, if given, bounds the model, shared evenly by languages and lengths,
    the most frequent items first; ``max_n`` is the longest n-gram."""

    rows_per_lang: int = 2000
    max_items: int | None = None
    max_n: int = 5


def words_of(text: str) -> list[str]:
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return WORD.findall(text.lower())


def _sample(labelled: DataFrame, key: str, lang: str, rows: int) -> tuple[DataFrame, int]:
    """About ``rows`` rows of each language at most, the same ones in every run; the number of languages."""
    counts = labelled.groupBy(F.col(lang).alias("lang_")).agg(F.count("*").alias("n_")).limit(MAX_LANGS + 1).collect()
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    spark = labelled.sparkSession
    # An Arrow table is read by the JVM alone; rows would start a second Python daemon on every executor, which stays.
    share = pa.array([rows / c.n_ for c in counts], pa.float64())
    shares = spark.createDataFrame(pa.table({"lang_": pa.array([c.lang_ for c in counts], pa.string()), "share_": share}))
    place = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(17)), F.lit(1 << 20)) / float(1 << 20)
    picked = labelled.join(F.broadcast(shares), F.col(lang) == F.col("lang_"))
    return picked.filter(place < F.col("share_")), max(1, len(counts))


def _word_counts(sample: DataFrame, text: str) -> DataFrame:
    def count(batches):
        for batch in batches:
            tally: Counter = Counter()
            for lang, body in zip(batch.column(0), batch.column(1), strict=True):
                if (found := body.as_py()) is not None:
                    lang_ = lang.as_py()
                    tally.update((lang_, word) for word in words_of(found))
            keys = list(tally)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([k[1] for k in keys], pa.string()),
                    pa.array([tally[k] for k in keys], pa.int64()),
                ],
                names=["lang", "item", "n"],
            )

    found = sample.select("lang_", F.col(text)).mapInArrow(count, "lang string, item string, n long")
    return found.groupBy("lang", "item").agg(F.sum("n").alias("n"))


def _grams(max_n: int) -> Column:
    padded = F.concat(F.lit(" "), F.col("item"), F.lit(" "))
    length = F.char_length("item") + 2

    def of_size(n: int) -> Column:
        starts = F.sequence(F.lit(1), length - n + 1)
        grams = F.transform(starts, lambda i: F.struct(F.lit(n).alias("size"), F.substring(padded, i, F.lit(n)).alias("item")))
        return F.when(length >= n, grams).otherwise(F.array().cast("array<struct<size:int,item:string>>"))

    return F.concat(*map(of_size, range(1, max_n + 1)))


def train(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          settings: Settings = Settings()) -> Rows:
    """Rows ``(size, item, lang, cost, total)`` of a model; size 0 holds whole words.

    Rows without a text or language teach nothing; without any row the model is
    empty. ``cost`` is minus the decimal logarithm of the relative frequency. The
    rows are collected: ``settings`` bounds their number.
    """
    own = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    own = own.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sample, langs = _sample(own, "key", "lang", settings.rows_per_lang)
    words = _word_counts(sample, "text")
    grams = words.select("lang", "n", F.explode(_grams(settings.max_n)).alias("g"))
    grams = grams.filter(F.col("g.item") != " ")  # every language has the space around words
    grams = grams.groupBy("lang", "g.size", "g.item").agg(F.sum("n").alias("n"))
    items = words.select("lang", F.lit(0).alias("size"), "item", "n").unionByName(grams)
    totals = items.groupBy("lang", "size").agg(F.sum("n").alias("total"))
    if settings.max_items is not None:
        group = Window.partitionBy("lang", "size").orderBy(F.desc("n"), "item")
        share = max(1, settings.max_items // (langs * (settings.max_n + 1)))
        items = items.withColumn("place", F.row_number().over(group)).filter(F.col("place") <= share)
    cost = -F.log10(F.col("n") / F.col("total"))
    found = items.join(F.broadcast(totals), ["lang", "size"])  # a row for each language and length
    return Rows(found.select("size", "item", "lang", cost.alias("cost"), "total").toArrow())


@dataclass(frozen=True)
class Rows:
    """The rows of a model as an Arrow table, which holds them in far less than Python objects."""

    table: pa.Table

    def __len__(self) -> int:
        return self.table.num_rows

    def __iter__(self) -> Iterator[tuple]:
        for batch in self.table.to_batches(10_000):
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


@dataclass(frozen=True)
class Model:
    """Hashes of items by length (0 for words), sorted, and their costs by language, NaN where a language lacks an item."""

    langs: list[str]
    keys: list[np.ndarray]
    costs: list[np.ndarray]
    worst: np.ndarray


_hash = xxhash.xxh3_64_intdigest


def compact(rows: Iterable[tuple], max_n: int) -> Model:
    """The rows of ``train`` as one sorted array of hashes and one table of costs for each length."""
    hashes, sizes, names, costs, totals = (array(kind) for kind in "QqqdQ")
    column: dict[str, int] = {}
    for size, item, lang, cost, total in rows:
        hashes.append(_hash(item))
        sizes.append(size)
        names.append(column.setdefault(lang, len(column)))
        costs.append(cost)
        totals.append(total)
    langs = sorted(column)
    place = np.argsort(np.argsort(list(column))) if column else np.empty(0, np.int64)
    hashes, sizes, costs, totals = (np.array(x) for x in (hashes, sizes, costs, totals))
    lang = place[np.array(names, np.int64)] if column else np.empty(0, np.int64)
    worst = np.zeros((max_n + 1, len(langs)))
    keys, tables = [], []
    for size in range(max_n + 1):
        own = sizes == size
        found, at = np.unique(hashes[own].astype(np.uint64), return_inverse=True)
        table = np.full((len(found), len(langs)), np.nan, np.float32)
        table[at, lang[own]] = costs[own]
        worst[size, lang[own]] = np.log10(totals[own].astype(np.float64)) + PENALTY
        keys.append(found)
        tables.append(table)
    for row in worst:  # a language without items of this length pays as much as the others
        row[row == 0] = row.max(initial=PENALTY)
    return Model(langs, keys, tables, worst)


class _Numbers(dict):
    """Numbers of words in the order in which they are first asked for."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Scorer:
    """Scores of texts by a model. The new words of many texts are looked up together."""

    #: Words whose scores are remembered, and characters of texts that are scored together.
    LIMIT, TOGETHER = 200_000, 1 << 20

    def __init__(self, model: Model, max_n: int):
        self.langs, self.model, self.max_n = model.langs, model, max_n
        self._forget()

    def _forget(self) -> None:
        self._numbers = _Numbers()
        self._scores = np.empty((0, len(self.langs)))
        self._parts = np.empty(0)

    def _found(self, size: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes the model knows, and the costs of those."""
        keys = self.model.keys[size]
        if not len(keys):
            return np.zeros(len(hashes), bool), np.empty((0, len(self.langs)))
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        known = keys[at] == hashes
        costs = self.model.costs[size][at[known]].astype(np.float64)
        return known, np.where(np.isnan(costs), self.model.worst[size], costs)

    def _learnt(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of words, and the part of each that is known: 1 in the dictionary, else that of its longest n-grams."""
        scores, parts = np.zeros((len(words), len(self.langs))), np.zeros(len(words))
        known, costs = self._found(0, np.fromiter(map(_hash, words), np.uint64, len(words)))
        scores[known], parts[known] = costs, 1.0
        left = np.flatnonzero(~known)
        for n in range(self.max_n, 0, -1):
            padded = [f" {words[i]} " for i in left]
            lengths = np.maximum(np.fromiter(map(len, padded), np.int64, len(left)) - n + 1, 0)
            grams = (_hash(w[k : k + n]) for w in padded for k in range(len(w) - n + 1))
            known, costs = self._found(n, np.fromiter(grams, np.uint64, int(lengths.sum())))
            owner = np.repeat(np.arange(len(left)), lengths)[known]
            hits = np.bincount(owner, minlength=len(left))
            longest = (lengths > 0) & (n == np.minimum(self.max_n, lengths + n - 1))
            parts[left[longest]] = hits[longest] / lengths[longest]
            sums = np.zeros((len(left), len(self.langs)))
            np.add.at(sums, owner, costs)
            done = hits > 0
            scores[left[done]] = sums[done] / hits[done, None]
            left = left[~done]
        return scores, parts

    def word(self, word: str) -> np.ndarray:
        return self._learnt([word])[0][0]

    def text(self, text: str | None) -> tuple[str, float]:
        """The language of a text and its share of the probability."""
        return self.judged([text])[0][:2]

    def judged(self, texts: Iterable[str | None]) -> list[tuple[str, float, float]]:
        """The language of each text, its share of the probability and the mean known part of the words."""
        results, held, size = [], [], 0
        for text in texts:
            held.append(words_of(text) if text else [])
            size += len(text or "")
            if size > self.TOGETHER:
                results += self._judged(held)
                held, size = [], 0
        return results + self._judged(held)

    def _judged(self, texts: list[list[str]]) -> list[tuple[str, float, float]]:
        if len(self._numbers) > self.LIMIT:
            self._forget()
        flat = [w for words in texts for w in words]
        at = np.fromiter(map(self._numbers.__getitem__, flat), np.int64, len(flat))
        new, self._numbers.new = self._numbers.new, []
        if new:
            scores, parts = self._learnt(new)
            self._scores, self._parts = np.concatenate([self._scores, scores]), np.concatenate([self._parts, parts])
        results, start = [], 0
        for words in texts:
            places, start = at[start : start + len(words)], start + len(words)
            if not words or not self.langs:
                results.append((UNKNOWN, 0.0, 0.0))
                continue
            totals = self._scores[places].sum(axis=0)
            best = int(totals.argmin())
            share = 1.0 / np.exp(np.maximum((totals[best] - totals) * math.log(10), -700)).sum()
            results.append((self.langs[best], float(min(1.0, share)), float(self._parts[places].mean())))
        return results


def predict(spark: SparkSession, docs: DataFrame, rows: Iterable[tuple], text: str = "text", keep: list[str] | None = None,
            max_n: int = Settings.max_n) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1) of the whole ``text``.

    ``und`` and 0 where the text is null or has no letter, or the model is
    empty. Ties go to the language that sorts first. Input columns of these
    names are replaced; repeated rows get equal results.
    """
    return _judged(spark, docs, rows, text, keep, max_n, ("lang_pred string", "score double"))


def _judged(spark: SparkSession, docs: DataFrame, rows: Iterable[tuple], text: str, keep: list[str] | None, max_n: int,
            outputs: tuple[str, ...]) -> DataFrame:
    model = spark.sparkContext.broadcast(compact(rows, max_n))
    kinds = [pa.string(), pa.float64(), pa.float64()][: len(outputs)]

    def make():
        scorer = Scorer(model.value, max_n)

        def apply(texts: pa.Array):
            results = scorer.judged(t.as_py() for t in texts)
            return [pa.array([r[i] for r in results], kind) for i, kind in enumerate(kinds)]

        return apply

    return arrow_columns(docs, [text], ", ".join(outputs), make, keep)


def accepted(spark: SparkSession, docs: DataFrame, min_score: float = 0.3, min_known: float = MIN_KNOWN) -> DataFrame:
    """The rows of ``docs`` whose language is recognised, columns unchanged.

    Learns from the rows' own ``lang``. Rows without a letter, of which less than
    ``min_known`` is known in any language, or whose best language has less than
    ``min_score`` of the probability, go.
    """
    rows, names = train(docs), docs.columns
    made = ("lang_pred", "score", "known_part")
    own = {c: free_name(docs, f"own_{c.lower()}") for c in names if c.lower() in made}
    outputs = ("lang_pred string", "score double", "known_part double")
    judged = _judged(spark, docs.withColumnsRenamed(own), rows, "text", None, Settings.max_n, outputs)
    kept = judged.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score) & (F.col("known_part") >= min_known))
    return kept.drop(*made).withColumnsRenamed({v: k for k, v in own.items()}).select(*names)
