"""Near-duplicate documents by one-permutation MinHash.

A text is the set of its distinct five-word shingles. One hash of each shingle
picks a bin and is the bin's candidate for the minimum; empty bins borrow from
bins drawn at random until one is full (optimal densification), so that each bin
agrees between two texts with a chance equal to their similarity. Runs of bins
are banded into buckets. In a bucket, candidate edges form a star around its most
central member instead of all pairs. Where a bucket still holds several components
after that, its members are compared in blocks of bounded size: a block counts what its
sets share by an index of their shingles, and returns no more links than it joins
members. Links are confirmed on the full sets, and pairs are never a table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.window import Window

from newsmill.llm.common import WordHashes, apart, arrow_columns, free_name, give_back, gram_hashes, list_array, mix, small_batches, split_words, word_hashes
from newsmill.llm.components import components
from newsmill.session import materialize


#: Pairs of the centre of a star in one task.
PAIRS_OF_HUB = 500
#: Members of a block, and shingles of their sets, on average at most.
BLOCK_MEMBERS, BLOCK_SHINGLES = 512, 1 << 21


@dataclass(frozen=True)
class Settings:
    """Words of a shingle, least similarity in per cent, and the bands.

    Two texts at the least similarity share a band with a chance of
    ``1 - (1 - s ** rows) ** bands``: at 85 per cent all but 3e-7.
    """

    shingle: int = 5
    percent: int = 85
    bands: int = 32
    rows: int = 6

    @property
    def bins(self) -> int:
        return self.bands * self.rows


def shingle_set(text: str | None, hashes: WordHashes, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text."""
    return _set_of(hashes.of(text.encode().lower().split()) if text else np.empty(0, np.uint64), size)


def _set_of(words: np.ndarray, size: int) -> np.ndarray:
    if len(words) == 0:
        return words
    grams = gram_hashes(words, min(size, len(words)))
    return np.unique(mix(grams + np.uint64(min(size, len(words)))))


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The ``shingle_set`` of each text, by the distinct words of some texts at a time; none are remembered."""
    for words, counts in split_words(texts) if len(texts) else ():
        own = word_hashes(words.dictionary, xxhash.xxh3_64_intdigest)[words.indices.to_numpy()]
        ends = np.cumsum(counts)
        yield from (_set_of(own[a:b], size) for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True))


class Sketcher:
    """Band hashes of shingle sets."""

    def __init__(self, settings: Settings):
        self.settings = settings
        bins = settings.bins
        self.edges = np.array([-(-(i << 64) // bins) for i in range(bins)], np.uint64)
        self.numbers = np.arange(bins, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.band_no = mix(np.arange(settings.bands, dtype=np.uint64) + np.uint64(1))

    def bins_of(self, shingles: np.ndarray) -> np.ndarray:
        """The least hash of each bin, empty bins filled."""
        starts = np.searchsorted(shingles, self.edges)
        full = starts < np.append(starts[1:], len(shingles))
        values = np.zeros(len(full), np.uint64)
        values[full] = shingles[starts[full]]
        source, empty, attempt = values.copy(), np.flatnonzero(~full), 0
        while len(empty):
            attempt += 1
            probe = (mix(self.numbers[empty] + np.uint64(attempt)) >> np.uint64(33)) % np.uint64(len(full))
            found = full[probe]
            values[empty[found]] = source[probe[found]]
            empty = empty[~found]
        return values

    def bands_of(self, shingles: np.ndarray) -> np.ndarray:
        if len(shingles) == 0:
            return np.empty(0, np.int64)
        rows = self.bins_of(shingles).reshape(self.settings.bands, self.settings.rows)
        band = self.band_no
        for i in range(self.settings.rows):
            band = mix(band * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
        return band.view(np.int64)


def sketch(docs: DataFrame, settings: Settings, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_shingles``, ``set_key`` (the same for equal sets only) and ``bands``.

    Without words ``set_key`` is null and ``bands`` empty.
    """

    def make():
        sketcher = Sketcher(settings)

        def apply(texts: pa.Array):
            sizes, keys, bands = [], [], []
            for own in shingle_sets(texts, settings.shingle):
                sizes.append(len(own))
                keys.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                bands.append(sketcher.bands_of(own))
            return [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), list_array(bands, "int64", pa.int64())]

        return apply

    return arrow_columns(docs, [text], "n_shingles long, set_key binary, bands array<long>", make, keep)


def _shingles(docs: DataFrame, settings: Settings) -> DataFrame:
    """``docs`` (node, same, text) with the shingle sets in place of the texts."""

    def make():
        def apply(texts: pa.Array):
            sets = [s.view(np.int64) for s in shingle_sets(texts, settings.shingle)]
            return [list_array(sets, "int64", pa.int64())]

        return apply

    return arrow_columns(docs, ["text"], "shingles array<long>", make, keep=["node", "same"])


def _enough(common: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int, percent: int):
    return common * 100 >= (a + b - common) * percent


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` whose full sets are similar enough.

    All pairs of a ``u`` follow its set through a task, one after the other. Very
    many are dealt out to several, each of which gets the set of ``u`` too.
    """
    small_batches(pairs.sparkSession)
    sizes = pairs.groupBy("u").agg(F.ceil(F.count("*") / PAIRS_OF_HUB).alias("parts"))
    dealt = pairs.join(sizes, "u").withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")))
    hubs = sizes.select("u", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    sets = sets.select("node", "shingles")
    rows = hubs.join(sets.withColumnRenamed("node", "u"), "u").select("u", "part", F.lit(None).cast(pairs.schema["v"].dataType).alias("v"), "shingles")
    rows = rows.unionByName(dealt.select("u", "part", "v").join(sets.withColumnRenamed("node", "v"), "v"))
    rows = rows.repartition("u", "part").sortWithinPartitions("u", "part", F.col("v").asc_nulls_first())
    kind = pairs.schema["u"].dataType

    def run(batches):
        hub, own = object(), []
        for batch in batches:
            us, vs, lists = batch.column("u").to_pylist(), batch.column("v").to_pylist(), batch.column("shingles")
            links = []
            for i, (u, v) in enumerate(zip(us, vs, strict=True)):
                found = lists[i].values.to_numpy()
                if v is None:
                    own = [*own, found] if hub == u and fresh else [found]
                    hub, fresh = u, True
                    continue
                fresh = False
                if any(_enough(len(np.intersect1d(x, found, assume_unique=True)), len(x), len(found), percent) for x in own):
                    links.append((u, v))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], batch.schema.field(n).type) for k, n in enumerate("uv")], names=["u", "v"])
        give_back()

    schema = StructType([StructField("u", kind), StructField("v", kind)])
    return rows.select("u", "v", "shingles").mapInArrow(run, schema).distinct()


def _buckets(classes: DataFrame) -> DataFrame:
    """Members of the buckets that hold several classes, with how central each is."""
    members = classes.select("node", "n_shingles", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = materialize(members.join(sizes, "bucket"), "near-members")
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    ranked = members.join(weight, "node").select("bucket", "node", "n_shingles", "weight")
    return materialize(ranked, "near-buckets")


def _star_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Each member of a bucket with the most central one, where their sizes allow a link."""
    stars = members.groupBy("bucket").agg(F.max(F.struct("weight", "node", "n_shingles")).alias("hub"))
    stars = stars.select("bucket", F.col("hub.node").alias("u"), F.col("hub.n_shingles").alias("hub_n"))
    pairs = members.join(stars, "bucket").filter(F.col("node") != F.col("u"))
    return pairs.filter(_sizes_allow("n_shingles", "hub_n", percent)).select("u", F.col("node").alias("v")).distinct()


def _sizes_allow(a: str, b: str, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def block_links(comp: np.ndarray, sets: list[np.ndarray], bands: np.ndarray, here: int, first: int, percent: int) -> list[tuple[int, int]]:
    """Pairs of rows that link rows of different components ``comp``, no more than it takes.

    Rows meet in band ``here``; a pair that met in an earlier one is left to that. With
    ``first`` above 0, rows before it are compared with those from there on only.
    """
    sizes = np.array([len(x) for x in sets], np.int64)
    values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    top = {c: c for c in comp.tolist()}

    def root(c):
        while top[c] != c:
            top[c] = c = top[top[c]]
        return c

    links = []
    for i in range(first or len(sets)):
        others = np.arange(max(first, i + 1), len(sets))
        small, large = np.minimum(sizes[i], sizes[others]), np.maximum(sizes[i], sizes[others])
        others = others[(small * 100 >= large * percent) & (comp[others] != comp[i])]
        others = others[~(bands[others, :here] == bands[i, :here]).any(axis=1)]
        if not len(others):
            continue
        starts, stops = np.searchsorted(values, sets[i], "left"), np.searchsorted(values, sets[i], "right")
        lengths = stops - starts
        at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        common = np.bincount(owner[at], minlength=len(sets))[others]
        for j in others[_enough(common, sizes[i], sizes[others], percent)].tolist():
            a, b = root(comp[i].item()), root(comp[j].item())
            if a != b:
                top[b] = a
                links.append((i, j))
    return links


def _block_links(mixed: DataFrame, classes: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links ``(u, v)`` between different components of the rows ``(bucket, node, comp)``.

    The members of a bucket go to one block, or where they are many to several, and every
    two blocks of it to a task. A member thus goes to as many tasks as its bucket has blocks.
    """
    weight = F.greatest(F.count("*") / BLOCK_MEMBERS, F.sum(F.col("n_shingles").cast("double")) / BLOCK_SHINGLES)
    sized = classes.select("node", "n_shingles", "bands")
    members = mixed.join(sized, "node")
    blocks = members.groupBy("bucket").agg(F.ceil(weight).alias("blocks"))
    members = members.join(blocks, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    members = members.select("bucket", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "node", "comp", "bands")
    kind = classes.schema["node"].dataType

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by([("own", "ascending"), ("node", "ascending")])
        bands = np.array(rows["bands"].to_pylist(), np.int64)
        here = int(np.flatnonzero((bands == key[0].as_py()).any(axis=0))[0])
        # A key that repeats with other texts has the bands of each; those of this bucket count.
        met = bands[:, here] == key[0].as_py()
        rows, bands = rows.filter(pa.array(met)).combine_chunks(), bands[met]
        own, comp = rows["own"].to_numpy(), rows["comp"].combine_chunks().dictionary_encode().indices.to_numpy()
        found = [x.values.to_numpy() for x in rows["shingles"].combine_chunks()]
        a, b = key[1].as_py(), key[2].as_py()
        first = int(np.searchsorted(own, b)) if a != b else 0
        links = block_links(comp, found, bands, here, first, settings.percent) if a == b or 0 < first < len(own) else []
        nodes = rows["node"].combine_chunks()
        many = sum(map(len, found)) > BLOCK_SHINGLES // 8
        found = rows = bands = None  # noqa: F841 (large sets go back before the worker waits)
        if many:
            give_back()
        return pa.table({n: nodes.take(pa.array([x[k] for x in links], pa.int64())) for k, n in enumerate("uv")})

    schema = StructType([StructField("u", kind), StructField("v", kind)])
    return members.join(sets.select("node", "shingles"), "node").groupBy("bucket", "a", "b").applyInArrow(run, schema)


def _links(members: DataFrame, classes: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """Each class but the smallest of its component, and the smallest: ``(u, v)``."""
    nodes = materialize(members.select("node").distinct(), "near-nodes")
    texts = apart(docs, "node", nodes)[1].join(nodes, "node", "left_semi").withColumn("same", F.xxhash64("text"))
    sets = materialize(_shingles(texts.dropDuplicates(["node", "same"]), settings), "near-sets")
    pairs = materialize(_star_pairs(members, settings.percent), "near-pairs")
    forest = components(_confirmed(pairs, sets, settings.percent), "near-forest")

    tops = forest.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    named = members.select("bucket", "node").join(tops, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = named.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    mixed = materialize(named.join(mixed.filter("lo <> hi").select("bucket"), "bucket", "left_semi"), "near-mixed")
    links = materialize(_block_links(mixed, apart(classes, "node", nodes)[1], sets, settings), "near-links")
    return components(links.unionByName(forest), "near-forest")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: its key, ``n_shingles``, ``component_id`` and ``kept``.

    Rows link where their shingle sets reach ``settings.percent``; ``component_id``
    is the smallest key that can be reached, and ``kept`` marks the row that has
    it. Rows that repeat a key are judged each by its own text. A text without
    words (or null) has no shingles and links with nothing; a row without a key
    takes the smallest key of its copies, or none, and is kept if it has none.
    Equal sets become one class before anything is compared.
    """
    own = docs.select(F.col(f"`{key}`").alias("node"), F.col(f"`{text}`").alias("text"))
    sketches = materialize(sketch(own, settings, keep=["node"]), "near-sketches")
    same = sketches.filter(F.col("set_key").isNotNull()).groupBy("set_key")
    classes = same.agg(F.min("node").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    classes = materialize(classes, "near-classes")
    known = classes.filter(F.col("node").isNotNull())
    forest = _links(_buckets(known), known, own, settings)
    firsts = classes.select("set_key", F.col("node").alias("first"))
    tops = forest.select(F.col("u").alias("first"), F.col("v").alias("top"))
    named = sketches.select("node", "n_shingles", "set_key").join(firsts, "set_key", "left").join(tops, "first", "left")
    component = F.coalesce("top", "first", "node")
    kept = F.coalesce(F.col("node") == component, F.col("node").isNull() & component.isNull())
    return named.select(F.col("node").alias(key), "n_shingles", component.alias("component_id"), kept.alias("kept"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row of each group of near duplicates, columns unchanged.

    Rows whose key is the smallest of their group stay; of rows that repeat that
    key one stays. Rows without a key all stay. Only rows that repeat a key are put
    in order. The keys of rows that go or repeat are looked up in a map first, so that
    the texts of most others are never shuffled.
    """
    names, place = docs.columns, free_name(docs, "place")
    rows, kept = free_name(docs, "rows"), free_name(docs, "kept")
    by_key = near_duplicates(docs, key, text, settings).groupBy(key).agg(F.count("*").alias(rows), F.max("kept").alias(kept))
    listed = by_key.filter(F.col(key).isNotNull() & (~F.col(kept) | (F.col(rows) > 1)))
    listed = materialize(listed.select(key, kept), "near-listed")
    clear, rest = apart(docs, key, listed)
    once = clear.unionByName(rest.join(listed.select(key), key, "left_anti").select(*names))
    repeated = listed.filter(kept).select(key)
    if not repeated.isEmpty():
        first = F.row_number().over(Window.partitionBy(key).orderBy(F.col(text).asc_nulls_last()))
        several = rest.join(repeated, key, "left_semi").select(*names).withColumn(place, first)
        once = once.unionByName(several.filter(F.col(place) == 1).drop(place))
    return once
