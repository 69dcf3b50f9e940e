import dataclasses
import glob
import math
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from newsmill.llm import common, ngram_lm


def tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + ["</s>"]


def brute_force(train, texts):
    count, pairs = Counter(), Counter()
    for text in train:
        words = tokens(text)
        count.update(words)
        pairs.update(zip(["<s>", *words], words, strict=False))
    spread, total, after = Counter(w for _, w in pairs), Counter(), defaultdict(lambda: [0, 0, 0])
    for (h, _), n in pairs.items():
        total[h] += n
        after[h][min(n, 3) - 1] += 1
    of = lambda values: ngram_lm.discounts(tuple(sum(v == k for v in values) for k in (1, 2, 3, 4)))
    d1, d2 = of(spread.values()), of(pairs.values())
    left = sum(d1[min(s, 3)] for s in spread.values()) / len(pairs)

    def low(w):
        return max(spread[w] - d1[min(spread[w], 3)], 0) / len(pairs) + left / (len(count) + 1)

    def high(h, w):
        if not total[h]:
            return low(w)
        n = pairs[h, w]
        return max(n - d2[min(n, 3)], 0) / total[h] + sum(d2[k + 1] * after[h][k] for k in range(3)) / total[h] * low(w)

    n, v = sum(count.values()), len(count)
    for text in texts:
        words = tokens(text)
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        score = sum(math.log10(high(h, w)) for h, w in zip(["<s>", *words], words, strict=False))
        yield len(words), sum(count[w] > 0 for w in words), base, score


@pytest.mark.parametrize("bucket", [24 << 20, 300])
def test_like_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(ngram_lm, "BUCKET_BYTES", bucket)
    rng = random.Random(5)
    say = lambda: " ".join(rng.choice(["The", "the", "of", "a", f"w{rng.randrange(60)}"]) for _ in range(rng.randrange(40)))
    train = [say() for _ in range(80)] + [None, "", "the " * 400]
    texts = [say() for _ in range(30)] + [None, "", "never seen words", "the " * 3000]
    model = ngram_lm.train(spark, spark.createDataFrame([(t,) for t in train], "text string"))
    assert (model.buckets > 1) == (bucket == 300) and bool(model.hot) == (bucket == 300)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = ngram_lm.score(spark, docs, model).orderBy("doc_id").collect()
    for r, (n, known, base, score) in zip(rows, brute_force(train, texts), strict=True):
        assert (r.n_tokens, r.n_known) == (n, known)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)
        assert r.perplexity == pytest.approx(10 ** (-score / n))


def test_counts_above_a_byte(spark):
    model = ngram_lm.train(spark, spark.createDataFrame([("a b " * 500,)], "text string"))
    reader, hashes = ngram_lm.Reader(model), ngram_lm.WordHashes(ngram_lm.xxhash.xxh3_64_intdigest)
    a, b = hashes.of([b"a"]), hashes.of([b"b"])
    assert reader.bigrams(a, b).tolist() == [500] and reader.bigrams(b, a).tolist() == [499]
    assert reader.bigrams(a, a).tolist() == [0]


def test_odd_rows(spark, odd_docs, no_docs):
    model = ngram_lm.train(spark, odd_docs)
    rows = ngram_lm.score(spark, odd_docs, model).collect()
    assert len(rows) == 8 and all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    nothing = ngram_lm.train(spark, no_docs)
    assert nothing.n_tokens == 0
    assert all(math.isfinite(r.score) for r in ngram_lm.score(spark, odd_docs, nothing).collect())
    assert ngram_lm.score(spark, no_docs, model).count() == 0


def test_other_file_systems_are_refused():
    with pytest.raises(ValueError):
        ngram_lm.mounted("hdfs://host/work")


def brute_force_of_order(order, train, texts):
    padded = [["<s>"] * (order - 1) + tokens(t) for t in train]
    grams = {order: Counter(tuple(p[i : i + order]) for p in padded for i in range(len(p) - order + 1))}
    for k in range(order - 1, 0, -1):
        grams[k] = Counter(g[1:] for g in grams[k + 1])
    discount = {k: ngram_lm.discounts(tuple(sum(v == i for v in grams[k].values()) for i in (1, 2, 3, 4))) for k in grams}
    after = {k: defaultdict(list) for k in grams}
    for k in grams:
        for g, n in grams[k].items():
            after[k][g[:-1]].append(n)
    vocabulary = {w for p in padded for w in p} - {"<s>"}

    def p(gram):
        k, below = len(gram), p(gram[1:]) if len(gram) > 1 else 1 / (len(vocabulary) + 1)
        found = after[k][gram[:-1]]
        if not found:
            return below
        d, n = discount[k], grams[k][gram]
        return max(n - d[min(n, 3)], 0) / sum(found) + sum(d[min(x, 3)] for x in found) / sum(found) * below

    for text in texts:
        words = ["<s>"] * (order - 1) + tokens(text)
        yield sum(math.log10(p(tuple(words[i : i + order]))) for i in range(len(words) - order + 1))


@pytest.mark.parametrize("order", [3, 4])
@pytest.mark.parametrize("bucket", [24 << 20, 300, 1500])
def test_longer_orders_like_brute_force(spark, monkeypatch, order, bucket):
    monkeypatch.setattr(ngram_lm, "BUCKET_BYTES", bucket)
    rng = random.Random(6)
    say = lambda: " ".join(rng.choice(["the", "of", "a", f"w{rng.randrange(9)}"]) for _ in range(rng.randrange(40)))
    train, texts = [say() for _ in range(80)] + [None, "", "the " * 400], [say() for _ in range(20)] + [None, "", "of never the a"]
    model = ngram_lm.train(spark, spark.createDataFrame([(t,) for t in train], "text string"), order=order)
    assert bool(model.hot_pairs) == (bucket < 2000)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = ngram_lm.score(spark, docs, model).orderBy("doc_id").collect()
    assert [r.score for r in rows] == pytest.approx(list(brute_force_of_order(order, train, texts)))


def test_longer_order_tells_scrambled_text_of_common_pairs(spark):
    """In both texts all pairs of words are known, but only one has the known order of three."""
    train = spark.createDataFrame([("a b c",), ("d b e",)] * 20, "text string")
    docs = spark.createDataFrame([(0, "a b c"), (1, "a b e")], "doc_id long, text string")
    of = lambda order: [r.score for r in ngram_lm.score(spark, docs, ngram_lm.train(spark, train, order=order)).orderBy("doc_id").collect()]
    pairs, threes = of(2), of(3)
    assert pairs[0] == pytest.approx(pairs[1]) and threes[0] > threes[1] + 0.5


def test_missing_files_are_an_error(spark):
    """Where a file of the model cannot be seen, nothing is scored as unseen words."""
    docs = spark.createDataFrame([("a b c a b",)] * 3, "text string")
    for order in (2, 3):
        model = ngram_lm.train(spark, docs, order=order)
        elsewhere = dataclasses.replace(model, folder=model.folder + "-not-mounted")
        with pytest.raises(FileNotFoundError, match="is its folder mounted"):
            ngram_lm.Scorer(elsewhere).texts([ngram_lm.tokens("a b", ngram_lm.WordHashes(ngram_lm.xxhash.xxh3_64_intdigest), order)])
        with pytest.raises(Exception, match="is its folder mounted"):
            ngram_lm.score(spark, docs, elsewhere).collect()
        assert all(r.n_known == r.n_tokens for r in ngram_lm.score(spark, docs, model).collect())


@pytest.mark.parametrize("size", [1, 7, 5000])
def test_packed_keys_find_what_plain_ones_find(tmp_path, monkeypatch, size):
    monkeypatch.setattr(ngram_lm, "PACKED", 1)
    rng = np.random.default_rng(size)
    keys = np.unique(np.concatenate([rng.integers(0, 1 << 64, size, np.uint64), rng.integers(0, 60, size, np.uint64), [np.uint64((1 << 64) - 1)]]))
    ngram_lm._save_keys(str(tmp_path), "gram2-0000000", keys)
    model = ngram_lm.Model(str(tmp_path), 1, (), (), ((0,) * 4,), (0,) * 4, 0, 0, 0, 2, (b"\x80", b"\x80"))
    reader = ngram_lm.Reader(model)
    packed = reader._open("gram2-0000000")
    assert isinstance(packed, ngram_lm.PackedKeys) and len(packed) == len(keys)
    wanted = np.concatenate([keys, keys + np.uint64(1), keys - np.uint64(1), rng.integers(0, 1 << 64, 100, np.uint64)])
    place, found = packed.find(wanted)
    assert found.tolist() == np.isin(wanted, keys).tolist() and (keys[place[found]] == wanted[found]).all()


def test_packed_files_score_the_same(spark, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(40))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plain = ngram_lm.score(spark, docs, ngram_lm.train(spark, docs, order=3)).orderBy("doc_id").collect()
    save = ngram_lm._save_keys
    monkeypatch.setattr(ngram_lm, "PACKED", 1)
    folder = str(ngram_lm.mounted(ngram_lm.work_dir(spark, "packed")))
    model = ngram_lm.train(spark, docs, order=3)
    for path in glob.glob(f"{model.folder}/*.npy"):
        name = os.path.basename(path)[:-4]
        os.makedirs(folder, exist_ok=True)
        array = np.load(path)
        keys = "value" not in name and array.ndim == 1 and array.dtype == np.uint64 and name.startswith(("gram", "context", "hotcontext"))
        (save if keys and len(array) else ngram_lm._save)(folder, name, array)
    assert ngram_lm.score(spark, docs, dataclasses.replace(model, folder=folder)).orderBy("doc_id").collect() == plain


def test_packed_sums_are_what_went_in():
    rng = np.random.default_rng(1)
    for top in (1, 255, 256, 70_000, 1 << 33, 1 << 64):
        values = rng.integers(0, top, 500, np.uint64, endpoint=top < 1 << 64)
        data = ngram_lm.pack(values)
        assert ngram_lm.unpack(pa.py_buffer(data), "uint64").tolist() == values.tolist()
        keys = np.sort(values)
        table = pa.table({"keys": pa.array([ngram_lm.pack_sorted(keys), None, ngram_lm.pack_sorted(keys[:3])], pa.binary())})
        assert ngram_lm._column(table, "keys", "uint64").tolist() == keys.tolist() + keys[:3].tolist()
    assert len(ngram_lm.pack(np.ones(1000, np.uint64))) < 100
    assert ngram_lm.unpack(pa.py_buffer(ngram_lm.pack(np.empty(0, np.uint64))), "uint32").size == 0


def test_as_many_words_are_common_as_there_is_room_for(spark, monkeypatch):
    monkeypatch.setattr(ngram_lm, "COMMON_WORDS", 20)
    counts = [(f"w{i}", 2 + i % 9) for i in range(50)]
    words = spark.createDataFrame(counts, "word string, n long")
    least = ngram_lm._least(words, sum(n for _, n in counts))
    above = lambda k: sum(n > k for _, n in counts)
    assert above(least) < 20 <= above(least - 1)
    assert ngram_lm._least(words.limit(5), 100) == 1


def test_words_split_by_arrow_are_those_of_the_bytes(monkeypatch):
    monkeypatch.setattr(common, "SPLIT_BYTES", 40)
    every = "".join(f"A{chr(i)}b" for i in range(128))
    texts = [every, None, "", " \t\n", " The the\u0085end \u00c9\u00a0x ", "a", *[f"w{i} w{i % 3}" for i in range(30)]]
    hashes = ngram_lm.WordHashes(ngram_lm.xxhash.xxh3_64_intdigest)
    for order in (2, 3):
        parts = list(ngram_lm._by_tokens(iter([pa.array(texts[:4]), pa.array([], pa.string()), pa.array(texts).slice(4)]), order, 20))
        assert len(parts) > 1
        own = np.concatenate([p.hashes[p.numbers] for p in parts])
        assert own.tolist() == np.concatenate([ngram_lm.tokens(t, hashes, order) for t in texts]).tolist()
        assert np.concatenate([p.lengths for p in parts]).tolist() == [len(ngram_lm.tokens(t, hashes, order)) for t in texts]


def test_small_counts_and_sums_take_little_room():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 501):
        counts = rng.integers(0, 16, n)
        packed = ngram_lm.pack_halves(counts)
        assert packed.nbytes == (n + 1) // 2 and ngram_lm.halves_at(packed, np.arange(n)).tolist() == counts.tolist()
        sums = np.sort(rng.integers(0, 300, (n, 4)), axis=1)[:, ::-1].astype(np.uint64)
        sums[: n // 100] += np.uint64(1 << 40)
        packed, place = ngram_lm.pack_sums(sums), rng.permutation(n)
        assert packed.nbytes == 4 * n + 32 * int((sums[:, 0] >= 255).sum())
        assert ngram_lm.sums_at(packed, place, n).tolist() == sums[place].astype(np.int64).tolist()


def test_keys_in_order_where_first_bits_do_not_tell():
    rng = np.random.default_rng(4)
    for keys in (rng.integers(0, 1 << 64, 999, np.uint64), rng.integers(0, 2000, 999, np.uint64), np.empty(0, np.uint64)):
        assert keys[ngram_lm.places_in_order(keys)].tolist() == sorted(keys.tolist())
        for bits in (11, 64):
            own = keys & np.uint64((1 << bits) - 1)
            first, number = ngram_lm.numbered(own, bits)
            assert own[first].tolist() == np.unique(own).tolist() and own[first][number].tolist() == own.tolist()
