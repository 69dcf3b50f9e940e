"""Interpolated modified Kneser-Ney model of n-grams and its scores of texts.

The n-grams of the training texts are counted by Spark: each task sums its own, the
sums are dealt out by the hash of the word before the last, and every bucket ends as
sorted arrays of 64-bit hashes beside their counts, in files of the shared folder.
All shorter n-grams that end those of a bucket are counted there too. What a word or
a frequent context adds up to is dealt out again and stored the same way. Workers map
the files into memory and look up whole batches at once.

A bucket is a bounded number of training bytes. Words that are too frequent for one
bucket are spread over all by the pair, and pairs that are by three words.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmill.llm.common import WordHashes, arrow_columns, give_back, join_hashes, small_batches, split_words, word_hashes
from newsmill.session import materialize, work_dir

#: Training bytes of a bucket, and tokens that a task sums at a time.
BUCKET_BYTES = 16 << 20
BATCH_TOKENS = 3_000_000
START, END = np.uint64(0x5EED0001), np.uint64(0x5EED0002)
#: Words that are sent as a rank of three bytes or less, at most: the ranks hold 22 bits, and every task has the words.
COMMON_WORDS = 1 << 20
#: Counts take half a byte each; from this one on they stand in a second array.
BIG = 15
#: Sums of a context take a byte each; from this total on they stand behind the others.
BIG_TOTAL = 255


def mounted(path: str) -> str:
    """The local path of a shared folder; files elsewhere cannot be mapped."""
    url = urlparse(path)
    if url.scheme not in ("", "file"):
        raise ValueError(f"{path}: the model is memory-mapped, so spark.checkpoint.dir must be a mounted folder")
    return url.path


def home(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _in(values: np.ndarray, those: np.ndarray) -> np.ndarray:
    """Which values are among the sorted ``those``."""
    if len(those) == 0:
        return np.zeros(len(values), bool)
    return those[np.minimum(np.searchsorted(those, values), len(those) - 1)] == values


def contexts_of(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Hashes of the contexts of one word, two words and so on; ``columns`` hold the words from the last one back."""
    found = [columns[1]]
    for words in columns[2:]:
        found.append(join_hashes(found[-1], words))
    return found


def gram_home(contexts: list[np.ndarray], word: np.ndarray, hot: np.ndarray, hot_pairs: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of n-grams: by the word before the last, if that is hot by both, and if these are hot by three."""
    at, rows = contexts[0], np.flatnonzero(_in(contexts[0], hot))
    if len(rows):  # hot pairs begin with hot words
        at, pair = at.copy(), join_hashes(contexts[0][rows], word[rows])
        if len(contexts) > 1:
            three = _in(pair, hot_pairs)
            pair[three] = join_hashes(contexts[1][rows[three]], word[rows[three]])
        at[rows] = pair
    return home(at, buckets)


def tokens(text: str | None, hashes: WordHashes, order: int = 2) -> np.ndarray:
    """Hashes of a text's words, A-Z in lower case, after ``order - 1`` marks of its start and before one of its end."""
    words = hashes.of(text.encode().lower().split()) if text else np.empty(0, np.uint64)
    return np.concatenate([[START] * (order - 1), words, [END]])


def numbered(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct key, in their order, and the number of each key among them; keys have ``bits`` bits at most."""
    shift = len(keys).bit_length()
    if bits + shift <= 64:  # one array is sorted faster than the places of another
        both = np.sort(keys.astype(np.uint64) << np.uint64(shift) | np.arange(len(keys), dtype=np.uint64))
        own, order = both >> np.uint64(shift), (both & np.uint64((1 << shift) - 1)).astype(np.int64)
    else:
        order = places_in_order(keys.astype(np.uint64, copy=False))
        own = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = own[1:] != own[:-1]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def places_in_order(keys: np.ndarray) -> np.ndarray:
    """Places of 64-bit keys in their order: sorted by their first bits, and again where these do not tell."""
    low = np.uint64((1 << len(keys).bit_length()) - 1)
    order = (np.sort(keys & ~low | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)
    own = keys[order]
    return order[np.argsort(own, kind="stable")] if (own[1:] < own[:-1]).any() else order


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.diff(first, append=len(keys))


@dataclass(frozen=True)
class Words:
    """Texts one after the other with their marks: the ``numbers`` of their words among ``hashes``, and the length of each text."""

    hashes: np.ndarray
    numbers: np.ndarray
    lengths: np.ndarray

    @property
    def bits(self) -> int:
        return len(self.hashes).bit_length()

    def last(self, order: int) -> np.ndarray:
        """Places of the last words of all n-grams."""
        starts = np.cumsum(self.lengths) - self.lengths
        ends = np.ones(len(self.numbers), bool)
        for i in range(order - 1):
            ends[starts + i] = False
        return np.flatnonzero(ends)


def _words(held: list[tuple[pa.DictionaryArray, np.ndarray]], order: int) -> Words:
    """Split texts with ``order - 1`` marks of its start before and one of its end behind each."""
    parts = pa.chunked_array([w for w, _ in held]).unify_dictionaries().chunks
    found, counts = np.concatenate([p.indices.to_numpy() for p in parts]), np.concatenate([c for _, c in held])
    hashes = word_hashes(parts[0].dictionary, xxhash.xxh3_64_intdigest)
    lengths = counts + order
    ends = np.cumsum(lengths)
    numbers = np.full(int(lengths.sum()), len(hashes), np.int32)
    numbers[np.arange(len(found)) + np.repeat(np.arange(len(counts)) * order + order - 1, counts)] = found
    numbers[ends - 1] = len(hashes) + 1
    return Words(np.append(hashes, [START, END]), numbers, lengths)


def _save(folder: str, name: str, array: np.ndarray) -> None:
    """Write a file as a whole, so that repeated attempts of a task do no harm."""
    part = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with open(part, "wb") as file:
        np.save(file, array)
    os.replace(part, f"{folder}/{name}.npy")


#: Arrays of at least so many sorted keys are stored without their first bits.
PACKED = 1 << 17
PACKED_BITS = 16


def _save_keys(folder: str, name: str, keys: np.ndarray) -> None:
    """Sorted keys; large arrays as six bytes a key, and the place where each start of two bytes begins."""
    if len(keys) < PACKED:
        _save(folder, name, keys)
        return
    starts = np.arange((1 << PACKED_BITS) + 1, dtype=np.uint64)[:-1] << np.uint64(64 - PACKED_BITS)
    places = np.append(np.searchsorted(keys, starts), len(keys)).astype(np.uint32)
    _save(folder, f"{name}.high", (keys >> np.uint64(16)).astype(np.uint32))
    _save(folder, f"{name}.low", keys.astype(np.uint16))
    _save(folder, name, places[:, None])


class PackedKeys:
    """Sorted keys as ``_save_keys`` stores large arrays of them, searched in place."""

    #: Halvings of all wanted keys at once; where a start has more keys, only those that are left go on.
    TOGETHER = 6

    def __init__(self, places: np.ndarray, high: np.ndarray, low: np.ndarray):
        self.places, self.high, self.low = places, high, low

    def __len__(self) -> int:
        return len(self.low)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of keys, and which of them are there: a binary search among those of the same start, all at once."""
        start = (wanted >> np.uint64(64 - PACKED_BITS)).astype(np.int64)
        high, low = (wanted >> np.uint64(16)).astype(np.uint32), wanted.astype(np.uint16)
        a, end = (self.places[start + i, 0].astype(np.int64) for i in (0, 1))
        left = end - a
        for _ in range(min(self.TOGETHER, int(left.max(initial=0)).bit_length())):
            a, left = self._halved(a, left, high)
        while (open_ := np.flatnonzero(left)).size:
            a[open_], left[open_] = self._halved(a[open_], left[open_], high[open_])
        place = np.minimum(a, len(self) - 1)
        same = (a < end) & (self.high[place] == high)
        found = same & (self.low[place] == low)
        open_ = np.flatnonzero(same & ~found)
        while open_.size:  # keys that differ in their last bits only
            a[open_] += 1
            at = np.minimum(a[open_], len(self) - 1)
            same = (a[open_] < end[open_]) & (self.high[at] == high[open_])
            hit = same & (self.low[at] == low[open_])
            place[open_[hit]], found[open_[hit]] = at[hit], True
            open_ = open_[same & ~hit]
        return place, found

    def _halved(self, a: np.ndarray, left: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = left >> 1
        middle = a + half
        less = (self.high.take(middle, mode="clip") < high) & (left > 0)
        return np.where(less, middle + 1, a), np.where(less, left - half - 1, half)


def _grouped(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """The distinct keys in order and the sums of their values."""
    order = places_in_order(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return [keys[first], *(np.add.reduceat(v[order], first, dtype=v.dtype) if len(keys) else v for v in values)]


def pack(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs, those of one place together, compressed."""
    size = next(w for w in (1, 2, 4, 8) if _top(values) < 1 << 8 * w)
    planes = values.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T
    return bytes([size]) + len(values).to_bytes(7, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: pa.Buffer, dtype: str) -> np.ndarray:
    head = data[:8].to_pybytes()
    size, n = head[0], int.from_bytes(head[1:], "little")
    raw = pa.decompress(data[8:], decompressed_size=size * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(f"<u{size}").reshape(n).astype(dtype)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted keys as the steps between them."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def _column(table: pa.Table, name: str, dtype: str) -> np.ndarray:
    parts = [unpack(x.as_buffer(), dtype) for x in table.column(name) if x.is_valid]
    parts = [np.cumsum(p, dtype=dtype) for p in parts] if name == "keys" else parts
    return np.concatenate([*parts, np.empty(0, dtype)])


# --- counting ---------------------------------------------------------------------


def _by_tokens(texts: Iterator[pa.Array], order: int, size: int = BATCH_TOKENS) -> Iterator[Words]:
    """The words of texts, about ``size`` at a time."""
    held, n = [], 0
    for array in texts:
        for words, counts in split_words(array) if len(array) else ():
            held.append((words, counts))
            n += len(words) + len(counts)
            if n >= size:
                own, held, n = _words(held, order), [], 0
                yield own
                own = None
    if held:
        own, held = _words(held, order), []
        yield own


def _least(words: DataFrame, size: int) -> int:
    """The least count that fewer than ``COMMON_WORDS`` words exceed; of ``size`` tokens or fewer, ``size // COMMON_WORDS`` always is one."""
    top = max(1, size // COMMON_WORDS)
    of = {r.n: r["count"] for r in words.groupBy(F.least("n", F.lit(top + 1)).alias("n")).count().collect()}
    above, least = of.get(top + 1, 0), top
    while least > 1 and above + of.get(least, 0) < COMMON_WORDS:
        above += of.get(least, 0)
        least -= 1
    return least


def _frequent(texts: DataFrame, limit: int, size: int, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Common words by falling count, words before another more than ``limit`` times, and pairs about so frequent.

    Each batch reports the pairs with more than their share of ``limit``; what is not
    reported of a pair is ``limit`` at most, so no pair above twice that is missed.
    """
    schema = "word long, next long, n long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _by_tokens((b.column(0) for b in batches), 2):
            last = own.last(2)
            before = own.numbers[last - 1]
            n = np.bincount(before, minlength=len(own.hashes))
            words, n = own.hashes[n > 0], n[n > 0]
            after = np.zeros(len(words), np.int64)
            none = np.ones(len(words), bool)
            if order > 2:
                pairs, times = counted(before.astype(np.int64) << own.bits | own.numbers[last])
                many = times > max(1, limit * len(last) / size)
                pairs, times = pairs[many], times[many]
                words, n = np.concatenate([words, own.hashes[pairs >> own.bits]]), np.concatenate([n, times])
                after = np.concatenate([after, own.hashes[pairs & ((1 << own.bits) - 1)].view(np.int64)])
                none = np.concatenate([none, np.zeros(len(pairs), bool)])
            columns = [pa.array(words.view(np.int64)), pa.array(after, mask=none), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "next", "n"])
            own = last = before = columns = None  # noqa: F841 (not held while the next ones are made)
        give_back()

    counts = texts.mapInArrow(count, schema).groupBy("word", "next").agg(F.sum("n").alias("n"))
    counts = materialize(counts.filter((F.col("n") > 1) & (F.col("next").isNull() | (F.col("n") > limit))), "ngram-words")
    least = min(limit, _least(counts.filter(F.col("next").isNull()), size))
    found = counts.filter(F.col("n") > F.when(F.col("next").isNull(), least).otherwise(limit)).toArrow()
    word, n = (found.column(c).to_numpy() for c in ("word", "n"))
    pair = found.column("next").is_valid().to_numpy()
    word, n = word.view(np.uint64), n.astype(np.int64)
    after = found.column("next").fill_null(0).to_numpy().view(np.uint64)
    common, of = word[~pair], n[~pair]
    hot = np.sort(common[of > limit])
    pair &= _in(word, hot)
    common = common[np.lexsort((common, -of))][: COMMON_WORDS - 1]
    return common, hot, np.stack([word[pair], after[pair]])


class Codes:
    """Words as ranks among the common ones; others stand as hashes of their own."""

    def __init__(self, common: np.ndarray):
        self.common = np.append(common, np.uint64(0))

    @cached_property
    def _sorted(self) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(self.common[:-1])
        return order, self.common[order]

    def of(self, words: np.ndarray) -> np.ndarray:
        order, those = self._sorted
        codes = np.zeros(len(words), np.uint32)
        if len(those):
            place = np.minimum(np.searchsorted(those, words), len(those) - 1)
            known = those[place] == words
            codes[known] = order[place[known]] + 1
        return codes

    @staticmethod
    def packed(codes: list[np.ndarray], words: list[np.ndarray], n: np.ndarray) -> bytes:
        parts = [(c & 0xFFFF).astype(np.uint16).tobytes() for c in codes]
        parts += [(c >> 16).astype(np.uint8).tobytes() for c in codes]
        rare = np.concatenate([w[c == 0] for c, w in zip(codes, words, strict=True)])
        return pa.compress(b"".join([*parts, n.astype(np.uint32).tobytes(), rare.tobytes()]), codec="zstd", asbytes=True)

    def unpacked(self, data: bytes, rows: int, size: int, order: int) -> tuple[list[np.ndarray], np.ndarray]:
        raw = pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True)
        low = np.frombuffer(raw, np.uint16, rows * order).reshape(order, rows)
        high = np.frombuffer(raw, np.uint8, rows * order, 2 * rows * order).reshape(order, rows)
        codes = low.astype(np.int64) | high.astype(np.int64) << 16
        n = np.frombuffer(raw, np.uint32, rows, 3 * rows * order)
        rare = np.frombuffer(raw[3 * rows * order + 4 * rows :], np.uint64)
        words = self.common[codes - 1]
        words[codes == 0] = rare
        return list(words), n


def _grams(texts: DataFrame, buckets: int, order: int, sent, hot: np.ndarray, hot_pairs: np.ndarray) -> DataFrame:
    """Summed n-grams of each batch, packed by bucket."""

    #: Words of an n-gram in the order by which those of a bucket are sent, counted from the last one back.
    sending = [1, 0, *range(2, order)]

    def summed(own: Words) -> tuple[list[np.ndarray], np.ndarray]:
        """The numbers of the words of distinct n-grams, from the last one back, and their counts."""
        last, bits = own.last(order), own.bits
        if bits * order < 64:
            keys = np.zeros(len(last), np.int64)
            for i in sending:
                keys = keys << bits | own.numbers[last - i]
            keys, n = counted(keys)
            return [(keys >> bits * (order - 1 - sending.index(i)) & ((1 << bits) - 1)).astype(np.int32) for i in range(order)], n
        columns = [own.hashes[own.numbers[last - i]] for i in range(order)]
        first, number = numbered(join_hashes(contexts_of(columns)[-1], columns[0]), 64)
        numbers, n = [own.numbers[last[first] - i] for i in range(order)], np.bincount(number)
        at = np.lexsort((numbers[0], numbers[1]))
        return [x[at] for x in numbers], n[at]

    def by_rank(own: Words, codes: Codes) -> tuple[Words, np.ndarray]:
        """The same words with numbers in the order of their ranks, and these."""
        ranks = codes.of(own.hashes)
        at = np.argsort(ranks, kind="stable")
        number = np.empty(len(at), np.int32)
        number[at] = np.arange(len(at))
        return Words(own.hashes[at], number[own.numbers], own.lengths), ranks[at]

    def flush(own: Words, codes: Codes) -> pa.RecordBatch:
        own, rank = by_rank(own, codes)
        numbers, n = summed(own)
        columns = [own.hashes[x] for x in numbers]
        bucket = gram_home(contexts_of(columns), columns[0], hot, hot_pairs, buckets)
        at = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
        del columns
        bucket, n, numbers = bucket[at], n[at], [x[at] for x in numbers]
        ranks = [rank[x] for x in numbers]
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])).tolist() + [len(bucket)]
        pieces = [slice(a, b) for a, b in zip(cuts, cuts[1:])]  # noqa: B905
        size = [(3 * order + 4) * (p.stop - p.start) + 8 * sum(int((x[p] == 0).sum()) for x in ranks) for p in pieces]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([int(bucket[p.start]) for p in pieces], pa.int32()),
                pa.array([p.stop - p.start for p in pieces], pa.int32()),
                pa.array(size, pa.int64()),
                pa.array([Codes.packed([x[p] for x in ranks], [own.hashes[x[p]] for x in numbers], n[p]) for p in pieces], pa.binary()),
            ],
            names=["bucket", "rows", "size", "data"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(sent.value)
        for own in _by_tokens((b.column(0) for b in batches), order):
            made = flush(own, codes)
            own = None
            yield made
        made = None  # noqa: F841 (not held while the worker waits)
        give_back()

    return texts.mapInArrow(run, "bucket int, rows int, size long, data binary")


SUMS = "home int, kind string, keys binary, a binary, b binary, c binary, d binary"


def _save_counts(folder: str, level: int, name: str, keys: np.ndarray, n: np.ndarray) -> None:
    _save_keys(folder, f"gram{level}-{name}", keys)
    _save(folder, f"count{level}-{name}", pack_halves(np.minimum(n, BIG)))
    _save(folder, f"bigkey{level}-{name}", keys[n >= BIG])
    _save(folder, f"bigcount{level}-{name}", n[n >= BIG])


def pack_halves(values: np.ndarray) -> np.ndarray:
    """Whole numbers below 16, two in a byte."""
    two = np.zeros(len(values) + len(values) % 2, np.uint8)
    two[: len(values)] = values
    return two[::2] | two[1::2] << 4


def halves_at(packed: np.ndarray, place: np.ndarray) -> np.ndarray:
    return packed[place >> 1] >> ((place & 1) << 2).astype(np.uint8) & 15


def pack_sums(values: np.ndarray) -> np.ndarray:
    """Rows of four sums, none above the first, as a byte each; rows too large for that have the place of their own numbers."""
    big = values[:, 0] >= BIG_TOTAL
    rows = values.astype(np.uint8)
    rows[big, 0] = BIG_TOTAL
    rows[big, 1:] = np.arange(int(big.sum()), dtype="<u4").view(np.uint8).reshape(-1, 4)[:, :3]
    return np.concatenate([rows, values[big].astype("<u8").view(np.uint8).reshape(-1, 4)])


def sums_at(packed: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """Rows of sums; ``n``: how many there are."""
    rows = packed[place].astype(np.int64)
    big = rows[:, 0] == BIG_TOTAL
    if big.any():
        at = n + 8 * (rows[big, 1:] @ np.array([1, 1 << 8, 1 << 16]))
        rows[big] = packed[at[:, None] + np.arange(8)].reshape(-1, 32).view("<u8")
    return rows


def _save_contexts(folder: str, kind: str, level: int, name: str, keys: np.ndarray, *sums: np.ndarray) -> None:
    """Contexts that were followed once by one word need no numbers."""
    once = sums[0] == 1
    _save_keys(folder, f"{kind}once{level}-{name}", keys[once])
    _save_keys(folder, f"{kind}{level}-{name}", keys[~once])
    _save(folder, f"{kind}value{level}-{name}", pack_sums(np.stack([s[~once] for s in sums], axis=1)))


def _followed(context: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Contexts with their total and the numbers of words that follow once, twice and more often."""
    return _grouped(context, n, *((n == k).astype(np.uint32) for k in (1, 2)), (n > 2).astype(np.uint32))


def _stored_grams(packed: DataFrame, folder: str, buckets: int, order: int, sent, hot: np.ndarray, hot_pairs: np.ndarray) -> DataFrame:
    """Stores each bucket; what its words, frequent contexts and counts add up to, packed by hash.

    The n-grams of a bucket, and all shorter ones that end them, are nowhere else, so
    that they are counted here: the longest by their occurrences, the others by the
    words before them. Only hot pairs are in several buckets.
    """

    def by_home(kind: str, keys: np.ndarray, *values: np.ndarray) -> Iterator[tuple]:
        place = home(keys, buckets)
        cuts = np.searchsorted(place, np.arange(buckets + 1))  # keys are sorted, so homes are
        for i in range(buckets):
            piece = slice(cuts[i], cuts[i + 1])
            if piece.start < piece.stop:
                yield i, kind, pack_sorted(keys[piece]), *(pack(v[piece]) for v in values), *[None] * (4 - len(values))

    def store(key: tuple, table: pa.Table) -> pa.Table:
        codes, name = Codes(sent.value), f"{key[0].as_py():07d}"
        parts = [codes.unpacked(d.as_py(), r.as_py(), s.as_py(), order) for d, r, s in zip(*(table.column(c) for c in ("data", "rows", "size")), strict=True)]
        columns = [np.concatenate([p[0][i] for p in parts]) for i in range(order)]
        n = np.concatenate([p[1] for p in parts]).astype(np.uint64)
        del parts
        rows, totals = [], np.zeros(4 * (order - 1) + 1, np.int64)
        for level in range(order, 1, -1):
            contexts = contexts_of(columns)
            keys = join_hashes(contexts[-1], columns[0])
            at = places_in_order(keys)
            keys = keys[at]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            n = np.add.reduceat(n[at], first)
            at = at[first]
            keys, context, columns = keys[first], contexts[-1][at], [c[at] for c in columns]
            if level == order:
                words = _grouped(columns[0], n)
            if level == 2:
                spread = _in(keys, hot_pairs) if order > 2 else np.zeros(len(keys), bool)
                rows += by_home("pair", keys[spread], n[spread])
                keys, n, context, columns = keys[~spread], n[~spread], context[~spread], [c[~spread] for c in columns]
                spreads = np.zeros(len(words[0]), np.uint32)
                last, follows = counted(columns[0])
                spreads[np.searchsorted(words[0], last)] = follows
                rows += by_home("word", *words, spreads)
                rows += by_home("context2", *_followed(context, n))
                totals[-1] = len(n)
            else:
                apart = _in(columns[1], hot)
                rows += by_home(f"context{level}", *_followed(context[apart], n[apart]))
                _save_contexts(folder, "context", level, name, *_followed(context[~apart], n[~apart]))
            _save_counts(folder, level, name, keys, n)
            totals[4 * (level - 2) : 4 * (level - 1)] = np.bincount(np.minimum(n, 5).astype(np.int64), minlength=6)[1:5]
            columns, n = columns[:-1], np.ones(len(n), np.uint64)
        rows.append((-1, "total", pack(totals), pack(np.array([key[0].as_py()], np.uint64)), *[None] * 3))
        types = [pa.int32(), pa.string(), *[pa.binary()] * 5]
        names = ["home", "kind", "keys", "a", "b", "c", "d"]
        columns = contexts = keys = n = context = at = first = words = last = table = None  # noqa: F841
        give_back()
        return pa.table({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(zip(names, types, strict=True))})

    return packed.groupBy("bucket").applyInArrow(store, SUMS)


def _stored_words(sums: DataFrame, folder: str, order: int, after: np.ndarray, buckets: int) -> tuple[np.ndarray, dict[int, int], tuple[bytes, bytes]]:
    """Stores the words and frequent contexts of each home; the totals of the model, the counts of hot pairs, and a manifest.

    The manifest has a bit for each bucket and each home of words whose files were written.

    ``after``: the last words of the hot pairs, whose spread no bucket knows.
    """
    counts = 4 * (order - 1) + 1

    def store(key: tuple, table: pa.Table) -> pa.Table:
        kinds = np.array(table.column("kind").to_pylist())
        totals, pairs = np.zeros(counts + 6, np.int64), [np.empty(0, np.uint64)] * 2
        stored = np.zeros(buckets, np.uint8)
        if key[0].as_py() < 0:
            stored[_column(table, "a", "uint64").astype(np.int64)] = 1
            for x in table.column("keys"):
                totals[:counts] += unpack(x.as_buffer(), "int64")
        else:
            of = {k: table.filter(pa.array(kinds == k)) for k in ("word", "pair", *(f"context{i + 2}" for i in range(order - 1)))}
            own = after[home(after, buckets) == key[0].as_py()]
            n, spread = _column(of["word"], "a", "uint64"), _column(of["word"], "b", "uint32")
            word = _grouped(
                np.concatenate([_column(of["word"], "keys", "uint64"), own]),
                np.concatenate([n, np.zeros(len(own), np.uint64)]),
                np.concatenate([spread, np.ones(len(own), np.uint32)]),
            )
            columns = (("keys", "uint64"), ("a", "uint64"), ("b", "uint32"), ("c", "uint32"), ("d", "uint32"))
            name = f"{key[0].as_py():07d}"
            for level in range(3, order + 1):
                summed = _grouped(*(_column(of[f"context{level}"], c, t) for c, t in columns))
                _save_contexts(folder, "hotcontext", level, name, *summed)
            context = _grouped(*(_column(of["context2"], c, t) for c, t in columns))
            keys = np.union1d(word[0], context[0])
            values = np.zeros((len(keys), 6), np.uint32 if max(_top(word[1]), _top(context[1])) < 1 << 32 else np.uint64)
            values[np.searchsorted(keys, word[0]), 0] = word[1]
            values[np.searchsorted(keys, word[0]), 1] = word[2]
            at = np.searchsorted(keys, context[0])
            for i in range(4):
                values[at, 2 + i] = context[1 + i]
            # Words that occur once, before one word and after one, need no numbers.
            once = (values == ONCE).all(axis=1)
            _save(folder, f"wordonce-{name}", keys[once])
            _save(folder, f"word-{name}", keys[~once])
            _save(folder, f"value-{name}", values[~once])
            totals[counts : counts + 4] = np.bincount(np.minimum(word[2], 5).astype(np.int64), minlength=6)[1:5]
            totals[counts + 4 :] = len(word[0]), int(word[1].sum())
            pairs = _grouped(*(_column(of["pair"], c, "uint64") for c in ("keys", "a")))
        stored = np.packbits(stored) if stored.any() else stored[:0]
        row = [totals.tobytes(), *(p.tobytes() for p in pairs), stored.tobytes()]
        columns = {c: pa.array([v], pa.binary()) for c, v in zip(("totals", "pairs", "n", "stored"), row, strict=True)}
        return pa.table({"home": pa.array([key[0].as_py()], pa.int32()), **columns})

    totals, pairs, homes, grams = np.zeros(counts + 6, np.int64), {}, np.zeros(buckets, np.uint8), b""
    rows = sums.groupBy("home").applyInArrow(store, "home int, totals binary, pairs binary, n binary, stored binary")
    for r in rows.toLocalIterator():
        if r.home < 0:
            grams = bytes(r.stored)
        else:
            homes[r.home] = 1
        totals += np.frombuffer(r.totals, np.int64)
        pairs.update(zip(np.frombuffer(r.pairs, np.uint64).tolist(), np.frombuffer(r.n, np.uint64).tolist(), strict=True))
    return totals, pairs, (grams, np.packbits(homes).tobytes())


#: What is stored of a word: count, spread, total as a context, and its followers seen once, twice, more often.
ONCE = np.array([1, 1, 1, 1, 0, 0], np.uint32)


def _top(values: np.ndarray) -> int:
    return int(values.max(initial=0))


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the numbers that all texts share.

    ``of_counts`` (by level, from pairs up) and ``of_spreads``: how many n-grams
    occur, and words follow other words, once, twice, three and four times.
    ``hot_pairs``: first and last word and count of the pairs that are in several buckets.
    """

    folder: str
    buckets: int
    hot: tuple[int, ...]
    hot_pairs: tuple[tuple[int, int, int], ...]
    of_counts: tuple[tuple[int, ...], ...]
    of_spreads: tuple[int, ...]
    n_bigrams: int
    vocabulary: int
    n_tokens: int
    order: int
    stored: tuple[bytes, bytes] = (b"", b"")
    """The manifest: a bit for each bucket of n-grams, and for each home of words, that has files."""


def train(spark: SparkSession, docs: DataFrame, text: str = "text", order: int = 2) -> Model:
    """Count the n-grams of up to ``order`` words of ``docs``; a null text is an empty one. Every row counts, copies too."""
    if order < 2:
        raise ValueError("the order is 2 at least")
    texts = docs.select(F.col(text).alias("text"))
    small_batches(spark)
    size = texts.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    size = (size[0] or 0) + size[1]
    buckets = max(1, -(-size // BUCKET_BYTES))
    folder = mounted(work_dir(spark, "ngram-lm"))
    os.makedirs(folder, exist_ok=True)
    common, hot, (before, after) = _frequent(texts, BUCKET_BYTES // 64, max(1, size), order)
    sent, pairs = spark.sparkContext.broadcast(common), join_hashes(before, after)
    packed = _grams(texts, buckets, order, sent, hot, np.sort(pairs))
    stored = _stored_grams(packed, folder, buckets, order, sent, hot, np.sort(pairs))
    t, counts, manifest = _stored_words(stored, folder, order, after, buckets)
    of_pairs = np.array([counts[p] for p in pairs.tolist()], np.int64)
    t[:4] += np.bincount(np.minimum(of_pairs, 5), minlength=6)[1:5]
    levels = 4 * (order - 1)
    of_counts = tuple(tuple(map(int, t[i : i + 4])) for i in range(0, levels, 4))
    t = t[levels:].tolist()
    hot_pairs = tuple(zip(before.tolist(), after.tolist(), of_pairs.tolist(), strict=True))
    return Model(folder, buckets, tuple(hot.tolist()), hot_pairs, of_counts, tuple(t[1:5]), t[0] + len(pairs), t[5], t[6], order, manifest)


# --- scoring ----------------------------------------------------------------------


def discounts(n: tuple[int, ...]) -> np.ndarray:
    """What is taken off counts of 0, 1, 2 and more (the estimates of Chen and Goodman)."""
    n1, n2, n3, n4 = (float(x) for x in n)
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(min(max(d, 0.05), k + 0.95) for k, d in enumerate(raw))])


class Reader:
    """Looks up hashes in the mapped arrays of a model."""

    def __init__(self, model: Model):
        self.model = model
        self.hot = np.array(model.hot, np.uint64)
        before, after, n = np.array(model.hot_pairs, np.uint64).reshape(-1, 3).T
        self.hot_pairs, self.hot_counts = _grouped(join_hashes(before, after), n)
        self.hot_before = _followed(before, n)
        self.stored = [np.unpackbits(np.frombuffer(bits, np.uint8)) for bits in model.stored]
        self._open = lru_cache(maxsize=1 << 14)(self._mapped)

    def _mapped(self, name: str) -> np.ndarray | PackedKeys | None:
        """The array or packed keys of a bucket; None if the manifest says that nothing was stored for it."""
        kind, bucket = name.rsplit("-", 1)
        stored = self.stored[kind.startswith(("word", "value", "hotcontext"))]
        if int(bucket) >= len(stored) or not stored[int(bucket)]:
            return None
        first = self._file(name)
        if first.ndim == 2 and "value" not in kind:
            return PackedKeys(first, self._file(f"{name}.high"), self._file(f"{name}.low"))
        return first

    def _file(self, name: str) -> np.ndarray:
        path = f"{self.model.folder}/{name}.npy"
        if not os.path.exists(path):
            raise FileNotFoundError(f"{path}: a file of the model is missing; is its folder mounted here?")
        return np.asarray(np.load(path, mmap_mode="r")) if os.path.getsize(path) > 128 else np.load(path)

    def _by_bucket(self, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(bucket.astype(np.uint16) if self.model.buckets <= 1 << 16 else bucket, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], np.diff(bucket[order]) != 0])).tolist() + [len(order)]
        for a, b in zip(cuts, cuts[1:]):  # noqa: B905
            yield int(bucket[order[a]]), order[a:b]

    @staticmethod
    def _find(keys: np.ndarray | PackedKeys | None, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if keys is None or len(keys) == 0:
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        if isinstance(keys, PackedKeys):
            return keys.find(wanted)
        place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return place, keys[place] == wanted

    def words(self, hashes: np.ndarray) -> np.ndarray:
        """Count, spread, total as a context, and its followers seen once, twice, more often."""
        out = np.zeros((len(hashes), 6), np.float64)
        if len(hashes):
            for bucket, rows in self._by_bucket(home(hashes, self.model.buckets)):
                place, found = self._find(self._open(f"word-{bucket:07d}"), hashes[rows])
                if found.any():
                    out[rows[found]] = self._open(f"value-{bucket:07d}")[place[found]]
                rows = rows[~found]
                _, found = self._find(self._open(f"wordonce-{bucket:07d}"), hashes[rows])
                out[rows[found]] = ONCE
            place, found = self._find(self.hot_before[0], hashes)
            for i in range(4):
                out[found, 2 + i] += self.hot_before[1 + i][place[found]]
        return out

    def contexts(self, level: int, contexts: list[np.ndarray]) -> np.ndarray:
        """Total of contexts of ``level - 1`` words, and their followers seen once, twice, more often."""
        keys = contexts[level - 2]
        if level == 2:
            return self.words(keys)[:, 2:]
        out = np.zeros((len(keys), 4), np.float64)
        hot = _in(contexts[0], self.hot)
        for kind, those, by in (("context", ~hot, contexts[0]), ("hotcontext", hot, keys)):
            at = np.flatnonzero(those)
            for bucket, rows in self._by_bucket(home(by[at], self.model.buckets)) if len(at) else ():
                rows = at[rows]
                several = self._open(f"{kind}{level}-{bucket:07d}")
                place, found = self._find(several, keys[rows])
                if found.any():
                    out[rows[found]] = sums_at(self._open(f"{kind}value{level}-{bucket:07d}"), place[found], len(several))
                rows = rows[~found]
                _, found = self._find(self._open(f"{kind}once{level}-{bucket:07d}"), keys[rows])
                out[rows[found]] = 1, 1, 0, 0
        return out

    def bigrams(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        return self.grams(2, [context], word)

    def grams(self, level: int, contexts: list[np.ndarray], word: np.ndarray) -> np.ndarray:
        """Counts of n-grams of ``level`` words."""
        keys = join_hashes(contexts[level - 2], word)
        out = np.zeros(len(keys), np.float64)
        if len(keys):
            for bucket, rows in self._by_bucket(gram_home(contexts[: level - 1], word, self.hot, self.hot_pairs, self.model.buckets)):
                place, found = self._find(self._open(f"gram{level}-{bucket:07d}"), keys[rows])
                if not found.any():
                    continue
                n = halves_at(self._open(f"count{level}-{bucket:07d}"), place[found]).astype(np.float64)
                big = n >= BIG
                if big.any():
                    own = keys[rows[found][big]]
                    at, _ = self._find(self._open(f"bigkey{level}-{bucket:07d}"), own)
                    n[big] = self._open(f"bigcount{level}-{bucket:07d}")[at]
                out[rows[found]] = n
            if level == 2:
                place, found = self._find(self.hot_pairs, keys)
                out[found] = self.hot_counts[place[found]]
        return out


class Scorer:
    def __init__(self, model: Model):
        self.model, self.reader = model, Reader(model)
        self.d1, self.d = discounts(model.of_spreads), [discounts(n) for n in model.of_counts]
        n1, n2 = model.of_spreads[:2]
        left = self.d1[1] * n1 + self.d1[2] * n2 + self.d1[3] * (model.vocabulary - n1 - n2)
        self.spread_total = float(model.n_bigrams)
        self.unseen = left / self.spread_total if self.spread_total else 1.0

    def texts(self, arrays: list[np.ndarray]) -> list[tuple[int, int, float, float]]:
        """Tokens, known tokens, base score and model score of texts that are hashes with marks."""
        hashes, numbers = np.unique(np.concatenate(arrays), return_inverse=True)
        found = self.words(Words(hashes, numbers, np.array([len(a) for a in arrays], np.int64)))
        return [(int(n), int(k), float(b), float(s)) for n, k, b, s in zip(*found, strict=True)]

    def words(self, own: Words) -> tuple[np.ndarray, ...]:
        """Tokens, known tokens, base score and model score of each text."""
        m, numbers, at = self.model, own.numbers, own.last(self.model.order)
        tokens = own.lengths - m.order + 1
        about = self.reader.words(own.hashes)
        count, spread = about[:, 0], about[:, 1]
        base = np.log10((count + 0.1) / (m.n_tokens + 0.1 * (m.vocabulary + 1)))
        low = self.unseen / (m.vocabulary + 1)
        if self.spread_total:
            low = low + np.maximum(spread - self.d1[np.minimum(spread, 3).astype(np.int64)], 0) / self.spread_total
        else:
            low = np.full(len(own.hashes), low)
        # An n-gram is the number of its context at the place before, and its last word; it is the context of the place behind.
        likely, of, context, bits = low[numbers[at]], about[:, 2:], numbers.astype(np.int64), len(numbers).bit_length()
        for level, d in enumerate(self.d, 2):
            seen = of[:, 0] > 0
            total = np.where(seen, of[:, 0], 1)
            share = np.where(seen, of[:, 1:] @ d[1:] / total, 1.0)
            first, gram = numbered(context[level - 2 : -1] << own.bits | numbers[level - 1 :], max(bits, own.bits) + own.bits)
            words = [own.hashes[numbers[first + level - 1 - i]] for i in range(level)]
            counts = self.reader.grams(level, contexts_of(words), words[0])
            high = np.maximum(counts - d[np.minimum(counts, 3).astype(np.int64)], 0)
            gram = np.concatenate([np.zeros(level - 1, np.int64), gram])
            before = context[at - 1]
            likely = high[gram[at]] / total[before] + share[before] * likely
            if level < m.order:
                context, of = gram, self.reader.contexts(level + 1, contexts_of([words[0], *words]))
        known = (count > 0).astype(np.int64)[numbers[at]]
        starts = np.cumsum(tokens) - tokens
        return tokens, *(np.add.reduceat(x, starts) for x in (known, base[numbers[at]], np.log10(likely)))


def score(spark: SparkSession, docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_tokens``, ``n_known``, ``base_score``, ``score`` and ``perplexity``.

    Scores are decimal logarithms of the probability of the words and the end; a
    null or empty text is an end alone. Equal texts get equal scores. Input
    columns of these names are replaced.
    """
    sent = spark.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(sent.value)

        def apply(texts: pa.Array):
            parts = [scorer.words(own) for own in _by_tokens([texts], sent.value.order, BATCH_TOKENS // 3)]
            tokens, known, base, own = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [np.empty(0)] * 4
            perplexity = [10.0 ** min(300.0, -s / n) for s, n in zip(own.tolist(), tokens.tolist(), strict=True)]
            return [
                pa.array(tokens.astype(np.int64)),
                pa.array(known.astype(np.int64)),
                pa.array(base, pa.float64()),
                pa.array(own, pa.float64()),
                pa.array(perplexity, pa.float64()),
            ]

        return apply

    outputs = "n_tokens long, n_known long, base_score double, score double, perplexity double"
    return arrow_columns(docs, [text], outputs, make, keep)
