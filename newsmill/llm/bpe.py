"""Byte-level BPE encoding and decoding with a local rank file.

The merges are tiktoken's, with no special tokens. Texts beyond ``CHUNK``
characters are encoded in chunks that end where the splitting pattern always
ends a match, so the ids are those of the whole text while memory stays bounded.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from newsmill.llm.common import arrow_columns, list_array

#: Characters of a chunk at least, where a text is longer.
CHUNK = 1 << 16
#: A rank file above this is refused: it is sent to every executor.
MAX_RANK_BYTES = 64 << 20
#: Where a match of the pattern always ends: before white space, and between
#: letters, digits and other marks, but for an apostrophe before a letter, and
#: never after white space, which may belong to the match that follows.
SAFE = regex.compile(
    r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])|(?<=[^\s\p{L}\p{N}])(?=\p{N})"
    r"|(?<=[^\s\p{L}\p{N}'])(?=\p{L})"
)


def read_ranks(path: str) -> bytes:
    """The bytes of a rank file: lines of base64 token, space, rank."""
    with open(path, "rb") as file:
        ranks = file.read(MAX_RANK_BYTES + 1)
    if len(ranks) > MAX_RANK_BYTES:
        raise ValueError(f"{path} is larger than {MAX_RANK_BYTES} bytes")
    return ranks


def build_encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines() if line.strip())
    merges = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def token_table(ranks: bytes) -> pa.BinaryArray:
    """The bytes of each token at the place of its rank, null where there is none."""
    tokens = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in ranks.splitlines() if line.strip())}
    return pa.array([tokens.get(i) for i in range(max(tokens, default=-1) + 1)], pa.binary())


def joined_tokens(tokens: pa.BinaryArray, lists: pa.ListArray) -> pa.BinaryArray:
    """The bytes of the tokens of each list, null for a null list; an id without a token raises."""
    found = tokens.take(lists.flatten())
    if found.null_count:
        raise KeyError("an id has no token")
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    # The tokens lie one after the other, so only the places where lists end are picked.
    starts = np.frombuffer(found.buffers()[1], np.int32, len(found) + 1, found.offset * 4) if len(found) else np.zeros(1, np.int32)
    offsets = starts[np.concatenate([[0], np.cumsum(lengths)])]
    valid = pa.array(lists.is_valid().to_numpy(zero_copy_only=False)).buffers()[1] if lists.null_count else None
    data = found.buffers()[2] or pa.py_buffer(b"")
    return pa.BinaryArray.from_buffers(pa.binary(), len(lists), [valid, pa.py_buffer(offsets), data])


def safe_chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """``text`` in order, cut at safe boundaries at least ``size`` apart."""
    start = 0
    while len(text) - start > size:
        found = SAFE.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def encode_text(encoding: tiktoken.Encoding, text: str) -> np.ndarray:
    parts = [encoding.encode_to_numpy(part, disallowed_special=()) for part in safe_chunks(text)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def encode(spark: SparkSession, docs: DataFrame, ranks_path: str, pattern: str, text: str = "text",
           keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``ids``, the token ids of the whole ``text`` (array<int>).

    Null and empty texts have no tokens. Repeated rows stay. A column ``ids`` of
    the input is replaced. The rank file is read once, on the driver.
    """
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def make():
        encoding = build_encoding(ranks.value, pattern)

        def apply(texts: pa.Array):
            ids = [encode_text(encoding, t.as_py() or "") for t in texts]
            return [list_array(ids, "int32", pa.int32())]

        return apply

    return arrow_columns(docs, [text], "ids array<int>", make, keep)


def decode(spark: SparkSession, encoded: DataFrame, ranks_path: str, pattern: str, ids: str = "ids",
           keep: list[str] | None = None) -> DataFrame:
    """``encoded`` with ``decoded``, the raw bytes of ``ids`` (binary).

    The bytes of any run of ids, whole characters or not; a null list gives null,
    an id outside the ranks raises. A column ``decoded`` of the input is replaced.
    """
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def make():
        tokens = token_table(ranks.value)
        return lambda lists: [joined_tokens(tokens, lists)]

    return arrow_columns(encoded, [ids], "decoded binary", make, keep)
