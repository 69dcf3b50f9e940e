"""Benchmark passages in training texts, found by winnowing.

Of every ``window - gram + 1`` neighbouring word k-grams the one with the least
hash is kept, so any run of ``window`` words that two texts share gives both the
same fingerprint at the same place in the run. Training and benchmark
fingerprints are joined, and each hit is extended to both sides: a window is
found when the k-gram and what equals it left and right make up ``window`` words.

An item with fewer words than a window is one window of its own length; those
lengths are looked up directly, as winnowing promises nothing for them.

All of it is built-in expressions over arrays of word hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.functions.binding import once
from newsmill.llm.common import UPPER, apart, free_name
from newsmill.session import materialize

WINDOW = 10
GRAM = 6
#: Fingerprints of the benchmark up to this number are broadcast (about 150 bytes
#: each); above it Spark joins them by their hash, dealt out like the documents.
BROADCAST_ROWS = 100_000
#: Characters that separate words, before A-Z become lower case.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text, A-Z in lower case; empty for null.

    A word counts as lower case when ``lower`` leaves it; only other words take
    the slower way that leaves letters beyond ASCII alone.
    """

    def of(word: Column) -> Column:
        plain = F.lower(word) == word
        return F.xxhash64(F.when(plain, word).otherwise(F.translate(word, UPPER, UPPER.lower())))

    words = F.filter(F.split(text, GAP), lambda w: w != "")
    return F.coalesce(F.transform(words, of), F.array().cast("array<bigint>"))


def _grams(hashes: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words; empty where there are fewer."""
    count = F.size(hashes) - (size - 1)
    starts = F.sequence(F.lit(0), count - 1)
    each = F.transform(starts, lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(size))))
    return F.when(count > 0, each).otherwise(F.array().cast("array<bigint>"))


def _print(at: Column, of: Column, size: int, around: Column | None = None) -> Column:
    return F.struct(
        at.cast("int").alias("at"),
        of.alias("hash"),
        F.lit(size).alias("size"),
        (F.lit(None).cast("array<bigint>") if around is None else around).alias("around"),
    )


PRINTS = "array<struct<at:int,hash:bigint,size:int,around:array<bigint>>>"


def fingerprints(hashes: Column, window: int = WINDOW, gram: int = GRAM) -> Column:
    """Winnowed k-grams of word hashes: ``array<struct<at, hash, size, around>>``.

    ``at`` is the place of the k-gram's first word; ``around`` the words next to
    it, nearest first, left then right. Texts shorter than a window have none.
    """
    span, side = window - gram + 1, window - gram

    def near(i: Column) -> Column:
        left = [F.get(hashes, i - j) for j in range(1, side + 1)]
        right = [F.get(hashes, i + (gram - 1 + j)) for j in range(1, side + 1)]
        return F.array(*left, *right) if side else F.array().cast("array<bigint>")

    def selected(grams: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(grams) - 1)
        starts = F.sequence(F.lit(0), F.size(grams) - span)
        least = F.transform(starts, lambda i: _extreme(F.least, [F.get(grams, i + j) for j in range(span)]))

        def rows(least: Column) -> Column:
            # A k-gram is kept if it is the least of one of the windows that hold it.
            windows = lambda i: [F.get(least, i - j) for j in range(span)]
            kept = F.filter(places, lambda i: _extreme(F.greatest, windows(i)) == F.get(grams, i))
            return F.transform(kept, lambda i: _print(i, F.get(grams, i), gram, near(i)))

        return F.when(F.size(grams) >= span, once(least, rows))

    return F.coalesce(once(_grams(hashes, gram), selected), F.array().cast(PRINTS))


def _extreme(function, values: list[Column]) -> Column:
    return function(*values) if len(values) > 1 else values[0]


def _runs_of(hashes: Column, size: int) -> Column:
    """Every run of ``size`` words, for items of that length; sizes are negative to keep them apart."""

    def rows(grams: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(grams) - 1)
        return F.when(F.size(grams) > 0, F.transform(places, lambda i: _print(i, F.get(grams, i), -size)))

    return F.coalesce(once(_grams(hashes, size), rows), F.array().cast(PRINTS))


def _agreeing(own: Column, other: Column, first: int, side: int) -> Column:
    """How many neighbours agree, from the nearest one on."""
    count: Column = F.lit(0)
    for j in reversed(range(first, first + side)):
        same = F.coalesce(F.get(own, F.lit(j)) == F.get(other, F.lit(j)), F.lit(False))
        count = F.when(same, count + 1).otherwise(F.lit(0))
    return count


def _known(benchmark: DataFrame, window: int, gram: int) -> tuple[DataFrame, list[int]]:
    """Fingerprints of the items, and the lengths of those that are shorter than a window."""
    items = benchmark.select("item_id", word_hashes(F.col("text")).alias("w")).filter(F.size("w") > 0)
    items = materialize(items, "bench-words")
    short = items.filter(F.size("w") < window)
    lengths = sorted(r.n for r in short.select(F.size("w").alias("n")).distinct().collect())  # below ``window``
    prints = items.filter(F.size("w") >= window).select("item_id", F.explode(fingerprints(F.col("w"), window, gram)).alias("p"))
    for n in lengths:
        own = short.filter(F.size("w") == n).select("item_id", F.explode(_runs_of(F.col("w"), n)).alias("p"))
        prints = prints.unionByName(own)
    known = prints.select(
        "item_id", F.col("p.hash").alias("hash"), F.col("p.size").alias("size"), F.col("p.around").alias("there"),
        F.lit(True).alias("known"),
    )
    known = materialize(known.distinct(), "bench-prints")
    return (F.broadcast(known) if known.count() <= BROADCAST_ROWS else known), lengths


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Shared runs ``(row_key, n_words, item_id, lo, hi)`` of ``docs`` (row_key, text) and
    ``benchmark`` (item_id, text), and for each row of ``docs`` one row with ``lo`` -1.

    ``lo`` and ``hi`` are the places of a run's first and last word. Runs overlap.
    """
    known, lengths = _known(benchmark, window, gram)

    def looked_up(hashes: Column) -> Column:
        # The first entry stands for the text itself and matches nothing.
        itself = F.array(_print(F.lit(-1), F.xxhash64("row_key"), 0))
        parts = [itself, fingerprints(hashes, window, gram), *(_runs_of(hashes, n) for n in lengths)]
        return F.struct(F.size(hashes).cast("long").alias("n_words"), F.concat(*parts).alias("prints"))

    texts = docs.select("row_key", once(word_hashes(F.col("text")), looked_up).alias("t"))
    spread = texts.select("row_key", F.col("t.n_words").alias("n_words"), F.explode("t.prints").alias("p"))
    joined = spread.select("row_key", "n_words", "p.*").join(known, ["hash", "size"], "left")
    side = window - gram
    whole = F.col("size") == gram
    left = F.when(whole, _agreeing(F.col("around"), F.col("there"), 0, side)).otherwise(F.lit(0))
    right = F.when(whole, _agreeing(F.col("around"), F.col("there"), side, side)).otherwise(F.lit(0))
    found = joined.filter((F.col("at") < 0) | F.col("known")).withColumns({"left": left, "right": right})
    found = found.filter(~whole | (F.col("left") + F.col("right") + gram >= window))
    return found.select(
        "row_key", "n_words", "item_id",
        (F.col("at") - F.col("left")).alias("lo"),
        (F.col("at") + F.abs("size") - 1 + F.col("right")).alias("hi"),
    )


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per key of ``docs``: ``n_words``, ``n_hit`` (words inside a benchmark
    window), ``items`` (sorted ids of the items found, as text) and ``contaminated``.

    Null and empty texts have no words; null or wordless items are never found, and
    an item without an id is found but not listed. Rows that repeat a key (null is
    a key too) count as one document with the words of the longest and the hits of
    all. Other input columns do not matter.
    """
    if not 0 < gram <= window:
        raise ValueError("gram must be between 1 and window")
    own = docs.select(F.struct(F.col(f"`{key}`").alias("key")).alias("row_key"), F.col(f"`{text}`").alias("text"))
    bench = benchmark.select(F.col(f"`{item}`").alias("item_id"), F.col(f"`{item_text}`").alias("text"))
    runs = materialize(hits(own, bench, window, gram), "bench-hits")
    base = runs.filter("lo < 0").groupBy("row_key").agg(F.max("n_words").alias("n_words"))
    inside = runs.filter("lo >= 0")
    words = inside.select("row_key", F.explode(F.sequence("lo", "hi")).alias("place")).distinct()
    words = words.groupBy("row_key").agg(F.count("*").alias("n_hit"))
    items = inside.select("row_key", F.col("item_id").cast("string").alias("item")).distinct()
    items = items.groupBy("row_key").agg(F.array_sort(F.collect_list("item")).alias("items"))
    n_hit = F.coalesce("n_hit", F.lit(0))
    return base.join(words, "row_key", "left").join(items, "row_key", "left").select(
        F.col("row_key.key").alias(key), "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
          gram: int = GRAM) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark window, columns unchanged.

    Each row is judged by its own text, whether keys repeat or not. The keys of
    contaminated rows are looked up in a map first, so that the texts of most
    others are never shuffled.
    """
    names, own = docs.columns, free_name(docs, "own_key")
    keyed = docs.withColumn(own, F.struct(F.col(f"`{key}`").alias("k"), F.xxhash64(f"`{text}`").alias("h")))
    judged = contamination(keyed.select(own, text), benchmark, own, text, window=window, gram=gram)
    dirty = materialize(judged.filter("contaminated").select(own), "bench-dirty")
    clear, rest = apart(keyed, own, dirty)
    return clear.unionByName(rest.join(dirty, own, "left_anti")).select(*names)
