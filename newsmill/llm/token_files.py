"""Token ids of documents in packed binary files, and random access to them.

A file holds the ids of many documents, each id in as many bits as the vocabulary needs:

    magic, bits, ids of a block                         header of 16 bytes
    blocks                                              packed ids, whole bytes each
    where each block begins, and where the last ends    8 bytes each
    key and number of ids of each document              an Arrow stream
    number of ids, places of the two tables, magic      trailer of 32 bytes

Eight ids take ``bits`` whole bytes, and a block is a multiple of eight ids, so a run of ids
is read from its own blocks alone and unpacked eight lanes at a time. Documents are dealt
out to files by ranges of their key. A file is written as its rows arrive and gets a name
of its own in each attempt; the manifest, a table that Spark commits, names those that count.
Folders may be local and shared, or any that ``pyarrow.fs`` can open.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from newsmill.llm.common import small_batches

MAGIC = b"PKIDS1\0\0"
_HEADER, _TRAILER = struct.Struct("<8sII"), struct.Struct("<QQQ8s")
#: Ids of a block; a multiple of eight.
BLOCK_IDS = 1 << 14
#: Ids read at a time, for documents that are longer in parts.
READ_IDS = 1 << 20
#: Characters encoded at a time.
CHUNK = 1 << 20
#: Bytes of the pieces whose ids are remembered, each counted with what it takes besides.
REMEMBERED, PER_PIECE = 160 << 20, 240
#: A tokenizer file above this is refused: it is sent to every executor.
MAX_TOKENIZER_BYTES = 64 << 20
#: Tasks that read files back at most.
READERS = 10_000


# ---- packing


def bits_for(vocabulary: int) -> int:
    """The least bits that hold the ids of a vocabulary."""
    return max(1, (vocabulary - 1).bit_length())


def _lanes(bits: int) -> Iterator[tuple[int, int, int]]:
    """First byte, shift and number of bytes of each of eight ids."""
    for lane in range(8):
        byte, shift = divmod(lane * bits, 8)
        yield byte, shift, -(-(shift + bits) // 8)


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` in ``bits`` bits each, least first, filled up with zeros to eight ids."""
    lanes = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    packed = np.zeros((len(lanes), bits), np.uint8)
    for lane, (byte, shift, size) in enumerate(_lanes(bits)):
        value = lanes[:, lane] << np.uint64(shift)
        for k in range(size):
            packed[:, byte + k] |= (value >> np.uint64(8 * k)).astype(np.uint8)
    return packed.tobytes()


def unpack(data: bytes | memoryview, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of packed bytes (uint32)."""
    packed = np.frombuffer(data, np.uint8).reshape(-1, bits)
    lanes = np.empty((len(packed), 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for lane, (byte, shift, size) in enumerate(_lanes(bits)):
        value = packed[:, byte].astype(np.uint64)
        for k in range(1, size):
            value |= packed[:, byte + k].astype(np.uint64) << np.uint64(8 * k)
        lanes[:, lane] = (value >> np.uint64(shift)) & mask
    return lanes.reshape(-1)[:n]


# ---- files


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if re.match(r"[a-z][a-z0-9+.-]*:", path) else f"file://{path}")


class Writer:
    """Writes one file front to back; holds a block of ids and the table of documents."""

    def __init__(self, out, bits: int, key: pa.DataType):
        self._out, self._bits, self._key = out, bits, key
        self._left = np.empty(0, np.uint32)
        self._keys, self._lengths, self._places = [], [], [_HEADER.size]
        self.n_ids = self.n_docs = 0
        out.write(_HEADER.pack(MAGIC, bits, BLOCK_IDS))

    def add(self, keys: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Documents with ``lengths`` ids each, which ``ids`` has in order."""
        self._keys.append(keys)
        self._lengths.append(lengths)
        self.n_docs += len(lengths)
        self.n_ids += len(ids)
        ids = np.concatenate([self._left, ids])
        whole = len(ids) - len(ids) % BLOCK_IDS
        for i in range(0, whole, BLOCK_IDS):
            self._block(ids[i : i + BLOCK_IDS])
        self._left = ids[whole:]

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self._bits)
        self._out.write(data)
        self._places.append(self._places[-1] + len(data))

    def close(self) -> None:
        if len(self._left):
            self._block(self._left)
        places, blocks = np.array(self._places, "<u8").tobytes(), self._places[-1]
        self._out.write(places)
        columns = [pa.chunked_array(self._keys, self._key), pa.chunked_array([pa.array(x, pa.int64()) for x in self._lengths], pa.int64())]
        table = pa.table(columns, names=["key", "n_ids"])
        with pa.ipc.new_stream(self._out, table.schema) as stream:
            stream.write_table(table)
        self._out.write(_TRAILER.pack(self.n_ids, blocks, blocks + len(places), MAGIC))
        self._out.close()


class TokenFile:
    """Random access to one file; reads its tables once, and blocks when they are asked for."""

    def __init__(self, path: str):
        system, place = filesystem(path)
        self._file = system.open_input_file(place)
        size = self._file.size()
        magic, self.bits, self.block_ids = _HEADER.unpack(self._file.read_at(_HEADER.size, 0))
        self.n_ids, places_at, docs_at, end = _TRAILER.unpack(self._file.read_at(_TRAILER.size, size - _TRAILER.size))
        if magic != MAGIC or end != MAGIC:
            raise ValueError(f"{path} is not a whole file of ids")
        self._places = np.frombuffer(self._file.read_at(docs_at - places_at, places_at), "<u8")
        with pa.ipc.open_stream(self._file.read_at(size - _TRAILER.size - docs_at, docs_at)) as stream:
            table = stream.read_all()
        self.keys = table["key"]
        #: Where each document begins, and where the last one ends.
        self.starts = np.concatenate([[0], np.cumsum(table["n_ids"].to_numpy())]).astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids at ``start`` up to ``stop``, from the blocks that hold them."""
        stop = min(stop, self.n_ids)
        if start >= stop:
            return np.empty(0, np.uint32)
        first, last = start // self.block_ids, -(-stop // self.block_ids)
        at = int(self._places[first])
        data = self._file.read_at(int(self._places[last]) - at, at)
        return unpack(data, self.bits, stop - first * self.block_ids)[start - first * self.block_ids :]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))

    def documents(self) -> Iterator[tuple[int, list[np.ndarray]]]:
        """Each document's number and its ids, in parts where it is long; neighbours are read together."""
        i, n = 0, len(self.keys)
        while i < n:
            start, j = int(self.starts[i]), max(i + 1, int(np.searchsorted(self.starts, self.starts[i] + READ_IDS, side="right")) - 1)
            stop = int(self.starts[j])
            if stop - start > READ_IDS:
                yield i, [self.ids(k, min(k + READ_IDS, stop)) for k in range(start, stop, READ_IDS)]
            else:
                ids = self.ids(start, stop)
                for d in range(i, j):
                    yield d, [ids[self.starts[d] - start : self.starts[d + 1] - start]]
            i = j

    def close(self) -> None:
        self._file.close()


# ---- encoding


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """``text`` in order, cut where a match of a byte-level splitting pattern always ends: before a space after no white space."""
    start = 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while at > 0 and text[at - 1].isspace():
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:]


_CUT = re.compile(r"(?<=\S)(?= )")
#: A piece that begins with white space needs one before it that does not end with any; one that
#: begins with a mark needs a letter or digit there, as marks that stand together are matched together.
_SPACE, _MARK, _OTHER = 0, 1, 2
#: Letters and digits up to here are such to every version of Unicode.
_LATIN = "\u024f"
#: Pieces encoded as one text while they are learnt.
JOINED = 64
_KINDS = {" ": _SPACE, "\n": _SPACE, ".": _MARK, ",": _MARK}


def pieces(text: str) -> list[str]:
    """``text`` cut before each space and line end, and before a full stop or comma ahead of one: not all cuts are safe."""
    marked = text.replace(". ", "\0. ").replace(", ", "\0, ").replace(".\n", "\0.\n").replace("\n", "\0\n")
    found = marked.replace(" ", "\0 ").split("\0")
    return found if found[0] else found[1:]


class _Numbers(dict):
    """Numbers of pieces in the order in which they are first asked for."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class _Table:
    """A numpy array that grows."""

    def __init__(self, dtype):
        self._values, self.size = np.empty(1 << 12, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        stop = self.size + len(values)
        while stop > len(self._values):
            self._values = np.concatenate([self._values, np.empty_like(self._values)])
        self._values[self.size : stop] = values
        self.size = stop

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return self._values[at]


class Encoder:
    """Ids of texts by the tokenizers library.

    A byte-level pattern splits a text before every space that follows something else, and
    merges never reach across. Where the tokenizer works so, a piece between two such places
    is encoded once and remembered; where it does not, texts are encoded whole.
    """

    def __init__(self, definition: str):
        # A task has one core; threads of its own would take others'.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_str(definition)
        self._tokenizer.no_padding()
        self._tokenizer.no_truncation()
        # Strings of special tokens are ordinary text in a document.
        self._tokenizer.encode_special_tokens = True
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self.vocabulary = max(vocabulary.values()) + 1
        # A character of a byte-level token stands for a byte.
        self._bytes = np.zeros(self.vocabulary, np.int64)
        for token, number in vocabulary.items():
            self._bytes[number] = len(token)
        self.splits = _splits_at_spaces(json.loads(definition))
        self._forget()

    def _forget(self) -> None:
        self._numbers, self._held = _Numbers(), 0
        self._ids, self._starts, self._sizes = _Table(np.uint32), _Table(np.int64), _Table(np.int64)
        self._begins, self._ends = _Table(np.uint8), _Table(np.uint8)

    def _by_library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts one after the other, and how many each has, each by a call of its own."""
        ids = [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``_by_library`` of pieces that may stand after each other: one call for many, cut by their bytes."""
        lines = ["".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)]
        ids, _ = self._by_library(lines)
        stops = np.cumsum(np.fromiter((len(w.encode()) for w in words), np.int64, len(words)))
        reached = np.cumsum(self._bytes[ids])
        at = np.searchsorted(reached, stops)
        if len(ids) and (reached[-1] != stops[-1] or not np.array_equal(reached[at], stops)):
            return self._by_library(words)  # a token that stands for other bytes than its own
        return ids, np.diff(at + 1, prepend=0)

    def _learn(self) -> None:
        new, self._numbers.new = self._numbers.new, []
        if not new:
            return
        begins = np.array([_KINDS.get(p[:1], _OTHER) for p in new], np.uint8)
        ends = np.array([_SPACE if p[-1:].isspace() else _MARK if p[-1:].isalnum() and p[-1] <= _LATIN else _OTHER for p in new], np.uint8)
        plain = np.array([p[:1] == " " for p in new]) & (ends != _SPACE)
        starts, sizes = np.empty(len(new), np.int64), np.empty(len(new), np.int64)
        for chosen, encode in ((np.flatnonzero(plain), self._joined), (np.flatnonzero(~plain), self._by_library)):
            ids, found = encode([new[i] for i in chosen])
            starts[chosen] = self._ids.size + np.cumsum(found) - found
            sizes[chosen] = found
            self._ids.extend(ids)
        for table, values in ((self._starts, starts), (self._sizes, sizes), (self._begins, begins), (self._ends, ends)):
            table.extend(values)
        self._held += sum(map(len, new)) + PER_PIECE * len(new)

    def _look_up(self, cut: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all pieces, and where the pieces of each text begin."""
        flat = list(itertools.chain.from_iterable(cut))
        at = np.fromiter(map(self._numbers.__getitem__, flat), np.int64, len(flat))
        self._learn()
        return at, np.concatenate([[0], np.cumsum([len(x) for x in cut], dtype=np.int64)]).astype(np.int64)

    def encode(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts one after the other, and how many each has."""
        texts = list(texts)
        if not self.splits:
            return self._by_library(texts)
        if self._held > REMEMBERED:
            self._forget()
        at, edges = self._look_up([pieces(t) if "\0" not in t else _CUT.split(t) for t in texts])
        # Texts with a cut that may lie within a match are cut again, at safe places only.
        begins, ends = self._begins[at[1:]], self._ends[at[:-1]]
        doubtful = ~((begins == _SPACE) & (ends != _SPACE) | (begins == _MARK) & (ends == _MARK))
        owner = np.searchsorted(edges, np.flatnonzero(doubtful) + 1, side="right") - 1
        again = np.unique(owner[edges[owner] != np.flatnonzero(doubtful) + 1])
        if len(again):
            new, new_edges = self._look_up([_CUT.split(texts[i]) for i in again])
            lists = np.split(at, edges[1:-1])
            for i, numbers in zip(again, np.split(new, new_edges[1:-1]), strict=True):
                lists[i] = numbers
            at = np.concatenate(lists)
            edges = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        sizes = self._sizes[at]
        done = np.concatenate([[0], np.cumsum(sizes)])
        ids = self._ids[np.repeat(self._starts[at] - done[:-1], sizes) + np.arange(done[-1])]
        return ids, np.diff(done[edges])


@functools.lru_cache(maxsize=1)
def encoder_of(definition: str) -> Encoder:
    """The encoder of a worker: later tasks of the same process find its pieces again."""
    return Encoder(definition)


def _splits_at_spaces(definition: dict) -> bool:
    pre = definition.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    added = definition.get("added_tokens") or []
    loose = any(t.get("lstrip") or t.get("rstrip") or re.search(r"\s", t.get("content", "")) for t in added)
    return bool(plain and not loose and not definition.get("normalizer") and (definition.get("model") or {}).get("type") == "BPE")


def encode_rows(encoder: Encoder, texts: Iterable[str], end_id: int | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(rows, lengths, ids)`` of neighbouring rows, about ``CHUNK`` characters at a time; each row's end id included."""
    end = np.empty(0, np.uint32) if end_id is None else np.array([end_id], np.uint32)
    held: list[str] = []

    def encoded(rows: list[str]):
        ids, lengths = encoder.encode(rows)
        if end_id is None:
            return len(rows), lengths, ids
        return len(rows), lengths + 1, np.insert(ids, np.cumsum(lengths), end_id).astype(np.uint32)

    size = 0
    for text in texts:
        if encoder.splits and len(text) > CHUNK:
            if held:
                yield encoded(held)
                held, size = [], 0
            ids = np.concatenate([*(encoder.encode([c])[0] for c in chunks(text)), end])
            yield 1, np.array([len(ids)]), ids
            continue
        held.append(text)
        size += len(text)
        if size > CHUNK:
            yield encoded(held)
            held, size = [], 0
    if held:
        yield encoded(held)


# ---- Spark


def read_definition(path: str) -> str:
    """The text of a tokenizer file."""
    with open(path, encoding="utf-8") as file:
        definition = file.read(MAX_TOKENIZER_BYTES + 1)
    if len(definition) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{path} is larger than {MAX_TOKENIZER_BYTES} characters")
    return definition


def write(spark: SparkSession, docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = 0,
          key: str = "doc_id", text: str = "text", files: int | None = None) -> DataFrame:
    """Write the ids of every whole ``text`` below ``folder`` in ascending ``key`` order; the manifest, a row a file.

    ``tokenizer`` is the path of a definition of the tokenizers library. ``end_id`` is put
    after each document (None: nothing). Null and empty texts have that id only; rows without
    a key come first; rows that repeat a key are written each, in the order of a hash of their
    texts. Ranges of keys become ``files`` files, or as many as the session deals shuffles
    to; a key that very many rows share is dealt out too. Other columns are ignored. An empty
    table gives a manifest without rows. The folder must be new.
    """
    own = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    order = ["key", "tie", "row"]
    own = own.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    dealt = own.repartitionByRange(files, *order) if files else own.repartitionByRange(*order)
    definition = spark.sparkContext.broadcast(read_definition(tokenizer))
    kind = own.schema["key"]
    schema = StructType([
        StructField("part", LongType()), *StructType.fromDDL("file string"), StructField("n_docs", LongType()), StructField("n_ids", LongType()),
        StructField("first_key", kind.dataType), StructField("last_key", kind.dataType),
    ])
    small_batches(spark)
    system, root = filesystem(folder)
    system.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, first, last = None, None, None
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.ids"
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, texts = batch.columns
            if writer is None:
                encoder = encoder_of(definition.value)
                system, root = filesystem(folder)
                bits = bits_for(max(encoder.vocabulary, (end_id or 0) + 1))
                writer, first = Writer(system.open_output_stream(f"{root}/{name}"), bits, keys.type), keys[:1]
            done = 0
            for rows, lengths, ids in encode_rows(encoder, (t.as_py() for t in texts), end_id):
                writer.add(keys[done : done + rows], lengths, ids)
                done += rows
            last = keys[-1:]
        if writer is not None:
            writer.close()
            numbers = [pa.array([x], pa.int64()) for x in (part, writer.n_docs, writer.n_ids)]
            yield pa.RecordBatch.from_arrays([numbers[0], pa.array([name]), *numbers[1:], first, last], names=schema.names)

    manifest = f"{folder.rstrip('/')}/manifest"
    dealt.sortWithinPartitions(*order).select("key", "text").mapInArrow(run, schema).write.parquet(manifest)
    return spark.read.schema(schema).parquet(manifest)


def read(spark: SparkSession, folder: str, key: str = "doc_id", ids: bool = False) -> DataFrame:
    """One row per document of the files that ``write`` left: its key, ``start``, ``n_tokens`` and ``ids_crc32``.

    ``start`` counts the ids of all documents before it, end ids included; the checksum is
    over its ids as little-endian unsigned 32-bit integers. ``ids`` adds them as array<int>.
    A file that is missing or cut raises.
    """
    manifest = files = spark.read.parquet(f"{folder.rstrip('/')}/manifest")
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = files.select("part", "file", before.cast("long").alias("before"))
    readers = max(1, min(READERS, manifest.count()))
    kind = manifest.schema["first_key"].dataType
    columns = "start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids
    schema = StructType([StructField(key, kind), *StructType.fromDDL(columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(f"{folder.rstrip('/')}/{row['file']}")
                yield from _rows(file, row["before"], schema.names, ids)
                file.close()

    return files.repartition(readers, "part").mapInArrow(run, schema)


def _rows(file: TokenFile, before: int, names: list[str], with_ids: bool) -> Iterator[pa.RecordBatch]:
    """The rows of one file, in batches of a bounded number of ids but for one document's."""
    done = held = 0
    sums: list[int] = []
    values: list[np.ndarray] = []
    n_docs = len(file.keys)
    for i, parts in file.documents():
        crc = 0
        for part in parts:
            crc = zlib.crc32(np.ascontiguousarray(part, "<u4"), crc)
        sums.append(crc)
        if with_ids:
            values.append(np.concatenate(parts).astype(np.int32))
            held += len(values[-1])
        if len(sums) >= 10_000 or held > READ_IDS or i == n_docs - 1:
            starts = file.starts[done : i + 2]
            columns = [file.keys[done : i + 1].combine_chunks(), pa.array(starts[:-1] + before), pa.array(np.diff(starts)), pa.array(sums, pa.int64())]
            if with_ids:
                columns.append(pa.array(values, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], names=names)
            done, held, sums, values = i + 1, 0, [], []
