import glob
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newsmill.llm import catalog, token_files
from newsmill.session import work_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")
DEFINITION = token_files.read_definition(PATH)
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.encode_special_tokens = True
ENCODER = token_files.Encoder(DEFINITION)
PIECES = st.sampled_from(
    ["a", "'s", "'", " ", "  ", "\n", "9", "12", "!", "é", "漢", "I'll", "<|endoftext|>", "\t", "ß", "\x00", "\x1c", ".", ",", ". ", ", ", ".\n", "b", "\x85", "\xa0", "　", "​"]
)


def by_library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=30).map("".join), max_size=4), st.integers(1, 6))
def test_ids_are_the_librarys(texts, size):
    assert ENCODER.splits
    ids, lengths = ENCODER.encode(texts)
    assert ids.tolist() == [i for t in texts for i in by_library(t)]
    assert lengths.tolist() == [len(by_library(t)) for t in texts]
    for text in texts:
        parts = list(token_files.chunks(text, size))
        assert "".join(parts) == text
        assert [i for p in parts for i in by_library(p)] == by_library(text)


def test_pieces_are_forgotten(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 10)
    encoder = token_files.Encoder(DEFINITION)
    for text in ["one two", "two three four", "one", "", "three"]:
        assert encoder.encode([text])[0].tolist() == by_library(text)


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, library = token_files.Encoder(token_files.read_definition(path)), Tokenizer.from_file(path)
    library.encode_special_tokens = True
    library.no_padding()
    library.no_truncation()
    assert not encoder.splits
    for text in ["A cat  sat.", "", " x "]:
        assert encoder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 32), st.integers(0, 100), st.randoms())
def test_packing_comes_back(bits, n, random):
    ids = np.array([random.getrandbits(bits) for _ in range(n)], np.uint32)
    data = token_files.pack(ids, bits)
    assert len(data) == -(-n // 8) * bits
    assert token_files.unpack(data, bits, n).tolist() == ids.tolist()
    if data:  # the plain meaning of the format: one run of bits, least first
        whole = int.from_bytes(data, "little")
        assert [(whole >> (bits * i)) & ((1 << bits) - 1) for i in range(n)] == ids.tolist()


@pytest.mark.parametrize("vocabulary, bits", [(1, 1), (2, 1), (3, 2), (256, 8), (257, 9), (50_257, 16), (65_537, 17)])
def test_least_bits(vocabulary, bits):
    assert token_files.bits_for(vocabulary) == bits


def expected(rows):
    """Rows ``(key, text)`` in file order, by the library alone."""
    result, start = [], 0
    for key, text in rows:
        ids = [*by_library(text or ""), 0]
        result.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return result


def test_given_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    found = catalog.op13_token_files(spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    assert [tuple(r) for r in found] == expected(rows)


def test_random_access(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 64)
    folder = work_dir(spark, "token-files")
    docs = spark.range(300).selectExpr("299 - id as doc_id", "repeat(concat('some words of ', id, ' '), cast(id % 7 as int)) as text")
    manifest = token_files.write(spark, docs.coalesce(1), folder, PATH, files=3).collect()
    assert sum(m.n_docs for m in manifest) == 300 and [m.part for m in sorted(manifest, key=lambda m: m.first_key)] == [0, 1, 2]
    texts = {r.doc_id: r.text for r in docs.collect()}
    for m in manifest:
        file = token_files.TokenFile(f"{folder}/{m.file}")
        assert file.bits == 16 and file.n_ids == m.n_ids and file.keys[0].as_py() == m.first_key and file.keys[-1].as_py() == m.last_key
        whole = [i for k in file.keys.to_pylist() for i in [*by_library(texts[k]), 0]]
        for start, stop in [(0, 1), (63, 65), (64, 128), (100, 100), (1, 10**9), (m.n_ids - 1, m.n_ids)]:
            assert file.ids(start, stop).tolist() == whole[start:stop]
        assert file.document(2).tolist() == [*by_library(texts[file.keys[2].as_py()]), 0]
    back = token_files.read(spark, folder, ids=True).collect()
    assert {r.doc_id: r.ids for r in back} == {k: [*by_library(t), 0] for k, t in texts.items()}


def test_odd_rows(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(token_files, "READ_IDS", 1000)
    folder = work_dir(spark, "token-files")
    token_files.write(spark, odd_docs, folder, PATH, files=4)
    found = [tuple(r) for r in token_files.read(spark, folder).orderBy("start").collect()]
    rows = odd_docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).collect()
    assert found == expected(rows)


def test_a_key_of_all_rows_is_dealt_out(spark):
    folder = work_dir(spark, "token-files")
    docs = spark.range(4000).selectExpr("cast(null as string) as doc_id", "'the same text' as text")
    manifest = token_files.write(spark, docs, folder, PATH, files=4).collect()
    assert max(m.n_docs for m in manifest) < 2000
    starts = [r.start for r in token_files.read(spark, folder).orderBy("start").collect()]
    assert starts == [i * (len(by_library("the same text")) + 1) for i in range(4000)]


def test_without_end_id_and_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(token_files, "CHUNK", 1000)
    folder = work_dir(spark, "token-files")
    docs = spark.createDataFrame([(1, "long text " * 20_000), (2, "x" * 50_000), (3, ""), (4, None)], "doc_id int, text string")
    token_files.write(spark, docs, folder, PATH, end_id=None)
    found = {r.doc_id: r.ids for r in token_files.read(spark, folder, ids=True).collect()}
    assert found == {1: by_library("long text " * 20_000), 2: by_library("x" * 50_000), 3: [], 4: []}


def test_empty_table(spark, no_docs):
    folder = work_dir(spark, "token-files")
    assert token_files.write(spark, no_docs, folder, PATH).count() == 0
    assert token_files.read(spark, folder).count() == 0


def test_lost_and_cut_files_raise(spark):
    folder = work_dir(spark, "token-files")
    token_files.write(spark, spark.range(9).selectExpr("id as doc_id", "'words' as text"), folder, PATH, files=1)
    (path,) = glob.glob(f"{folder}/*.ids")
    with open(path, "r+b") as file:
        file.truncate(60)
    with pytest.raises(ValueError):
        token_files.TokenFile(path)


def test_definition_has_a_bound(tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "MAX_TOKENIZER_BYTES", 10)
    (tmp_path / "t.json").write_text("x" * 11)
    with pytest.raises(ValueError):
        token_files.read_definition(str(tmp_path / "t.json"))
