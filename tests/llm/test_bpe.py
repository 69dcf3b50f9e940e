import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newsmill.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ENCODING = bpe.build_encoding(bpe.read_ranks(PATH), PATTERN)
PIECES = st.sampled_from(["a", "'s", "'", " ", "  ", "\n", "9", "12", "!", "é", "漢", "I'll", "<|endoftext|>", "\t", "ß", " "])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=40), st.integers(1, 8))
def test_chunks_keep_the_ids(parts, size):
    text = "".join(parts)
    chunks = list(bpe.safe_chunks(text, size))
    assert "".join(chunks) == text
    ids = [i for c in chunks for i in ENCODING.encode_ordinary(c)]
    assert ids == ENCODING.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 200_000, " " * 200_000 + "x", "ab1! " * 60_000, "<|endoftext|>"])
def test_long_texts(text):
    assert bpe.encode_text(ENCODING, text).tolist() == ENCODING.encode_ordinary(text)


def test_odd_rows(spark, odd_docs):
    encoded = bpe.encode(spark, odd_docs, PATH, PATTERN)
    rows = bpe.decode(spark, encoded, PATH, PATTERN).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r.ids == ENCODING.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
        assert r.score == "x"


def test_parts_of_characters_decode(spark):
    ids = ENCODING.encode_ordinary("漢")[:1]
    rows = bpe.decode(spark, spark.createDataFrame([(ids,), (None,)], "ids array<int>"), PATH, PATTERN).collect()
    assert bytes(rows[0].decoded) == ENCODING.decode_bytes(ids) and rows[1].decoded is None


def test_tokens_are_joined_like_the_library():
    tokens = bpe.token_table(bpe.read_ranks(PATH))
    texts = ["skipped", "漢字 and more", None, "", " the end", None, "<|endoftext|>"]
    lists = pa.array([None if t is None else ENCODING.encode_ordinary(t) for t in texts], pa.list_(pa.int32()))
    for start in range(len(texts) + 1):
        want = [None if t is None else t.encode() for t in texts[start:]]
        assert bpe.joined_tokens(tokens, lists.slice(start)).to_pylist() == want
    for bad in (len(tokens), -1, None):
        with pytest.raises((KeyError, IndexError)):
            bpe.joined_tokens(tokens, pa.array([[0, bad]], pa.list_(pa.int32())))
    gap = bpe.token_table(b"YQ== 0\nYg== 2\n")
    assert bpe.joined_tokens(gap, pa.array([[2, 0]], pa.list_(pa.int32()))).to_pylist() == [b"ba"]
    with pytest.raises(KeyError):
        bpe.joined_tokens(gap, pa.array([[1]], pa.list_(pa.int32())))


def test_empty_table(spark, no_docs):
    assert bpe.encode(spark, no_docs, PATH, PATTERN).count() == 0


def test_rank_file_has_a_bound(tmp_path, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_RANK_BYTES", 10)
    (tmp_path / "ranks").write_bytes(b"x" * 11)
    with pytest.raises(ValueError):
        bpe.read_ranks(str(tmp_path / "ranks"))
