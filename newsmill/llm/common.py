"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: The C library, where it can be told to give free memory back (glibc).
_LIBC = ctypes.CDLL(None) if hasattr(ctypes.CDLL(None), "malloc_trim") else None
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The ASCII white space that ends a word.
NOT_SPACE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def id_fold(key: Column, parts: int) -> Column:
    """A stable part of the rows, 0 to ``parts - 1``; a null key goes to part 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts, F.lit(0))


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and all other letters as they are."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or the first longer form of it that names no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


#: Bits of a key map for each key, and bits of one bitmap of Spark's.
KEY_BITS, BITMAP_BITS = 16, 32_768


def apart(df: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose ``key`` is surely not in ``keys``, and those whose key may be.

    A join with few ``keys`` has to shuffle only the second part. The hash of each key sets
    a bit of a map; about 6 of 100 rows with other keys meet a bit that is set. The map alone
    is broadcast, two bytes a key. ``keys`` is read twice and has ``key`` in the type of ``df``.
    """
    bits = max(BITMAP_BITS, KEY_BITS * keys.count())

    def place(names: tuple[str, str]) -> list[Column]:
        at = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(bits).cast("long"))
        return [F.floor(at / BITMAP_BITS).alias(names[0]), (at % BITMAP_BITS).alias(names[1])]

    part, bit, bitmap = (free_name(df, n) for n in ("map_part", "map_bit", "map_bits"))
    # Keys are dealt out first: each task would else send a bitmap for every part.
    maps = keys.select(*place((part, bit))).repartition(part).groupBy(part).agg(F.bitmap_construct_agg(bit).alias(bitmap))
    placed = df.select("*", *place((part, bit))).join(F.broadcast(maps), part, "left")
    byte = F.substr(F.col(bitmap), F.floor(F.col(bit) / 8).cast("int") + 1, F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (F.col(bit) % 8).cast("int")) == 1
    found = F.coalesce(is_set, F.lit(False))
    names = [f"`{c}`" for c in df.columns]
    return placed.filter(~found).select(*names), placed.filter(found).select(*names)


def without(df: DataFrame, names: Sequence[str]) -> list[StructField]:
    """The fields of ``df`` that an operator's own columns ``names`` leave in place."""
    own = {n.lower() for n in names}
    return [f for f in df.schema.fields if f.name.lower() not in own]


#: Bytes of an Arrow batch. Spark's own default lets a few long texts, or many short ones, fill
#: buffers on both sides of a worker several times over.
BATCH_BYTES = 8 << 20
_BATCH, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def small_batches(spark: SparkSession) -> None:
    """Send batches of ``BATCH_BYTES`` to Python, unless the session has a size of its own."""
    if spark.conf.get(_BATCH, None) == _DEFAULT:
        spark.conf.set(_BATCH, BATCH_BYTES)


def give_back() -> None:
    """Return what a finished task no longer holds to the system: Spark keeps its workers for later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def arrow_columns(
    df: DataFrame,
    inputs: Sequence[str],
    outputs: str,
    make: Callable[[], Callable[..., Sequence[pa.Array]]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` with columns that a function of Arrow arrays makes batch by batch.

    ``make()`` runs once in a task and returns the function; it gets the arrays
    of ``inputs`` and returns those of ``outputs`` (a DDL schema). ``keep`` names
    the columns that stay, all by default. An output replaces an input column
    of the same name.
    """
    small_batches(df.sparkSession)
    made = StructType.fromDDL(outputs)
    stay = [f for f in without(df, made.names) if keep is None or f.name in keep]
    schema = StructType(stay + made.fields)
    # A column that stays is not sent a second time for being an input.
    names = [f.name for f in stay]
    extra = [c for c in inputs if c not in names]
    hidden = [free_name(df, f"arg{i}") for i in range(len(extra))]
    source = df.select(
        *(F.col(f"`{c}`") for c in names), *(F.col(f"`{c}`").alias(a) for c, a in zip(extra, hidden, strict=True))
    )
    n_stay, order = len(stay), [(names + extra).index(c) for c in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            columns = batch.columns
            results = list(apply(*(columns[i] for i in order)))
            yield pa.RecordBatch.from_arrays(columns[:n_stay] + results, names=schema.names)
        apply = batch = columns = results = None  # noqa: F841 (the last batch is not held while the worker waits)
        give_back()

    return source.mapInArrow(run, schema)


def list_array(parts: Sequence[np.ndarray], dtype: str, value_type: pa.DataType) -> pa.ListArray:
    """An Arrow list array of numpy arrays."""
    lengths = np.fromiter((len(p) for p in parts), np.int64, len(parts))
    values = np.concatenate([*parts, np.empty(0, dtype)]).astype(dtype, copy=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, value_type))


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered up to a number of words."""

    LIMIT = 200_000

    def __init__(self, digest: Callable[[bytes], int]):
        super().__init__()
        self._digest = digest

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = self._digest(word)
        return value

    def of(self, words: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: Bytes of the texts that are split into words at a time, and more only where one text has more.
SPLIT_BYTES = 4 << 20


def split_words(texts: pa.Array) -> Iterator[tuple[pa.DictionaryArray, np.ndarray]]:
    """The words of texts, A-Z in lower case, and how many each text has, some texts at a time."""
    texts = texts.fill_null("")
    part = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)) // SPLIT_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:]):  # noqa: B905
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.slice(a, b - a)))
        words, ends = lists.flatten(), lists.offsets.to_numpy()
        full = pc.binary_length(words).to_numpy() > 0
        before = np.concatenate([[0], np.cumsum(full)])
        yield words.filter(pa.array(full)).dictionary_encode(), np.diff(before[ends - ends[0]])


def word_hashes(distinct: pa.Array, digest: Callable[[bytes], int]) -> np.ndarray:
    """64-bit hashes of an array of words."""
    return np.fromiter(map(digest, distinct.cast(pa.binary()).to_numpy(zero_copy_only=False)), np.uint64, len(distinct))


#: Odd multipliers of the mixing step (the constants of a well-known 64-bit finalizer).
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(33))


def join_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One hash for pairs of hashes, in order."""
    return mix(left * _STEP + right)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` neighbouring words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    grams = words[:n]
    for i in range(1, size):
        grams = join_hashes(grams, words[i : i + n])
    return grams
