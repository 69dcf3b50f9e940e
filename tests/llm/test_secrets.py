from newsmill.llm import secrets

HEX = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"


def test_candidates(spark):
    docs = spark.createDataFrame(
        [(1, f'set token = "{HEX}"### now', "a/b"), (2, "password=9855ae4fa49702326c x", None), (3, "plain words only 1234", "p"),
         (4, f"{HEX} {HEX}", "p")],
        "doc_id long, text string, source string",
    )
    found = {(r.key, r.place): (r.finding, r.before, r.after) for r in secrets.candidates(docs).collect()}
    assert set(found) == {(1, 3), (2, 0), (4, 0), (4, 1)}
    assert found[1, 3][0] == HEX and found[1, 3][1].endswith('set token = "') and found[1, 3][2] == "now"
    assert found[2, 0][0] == "9855ae4fa49702326c" and found[2, 0][1].endswith("password=")


def corpus(spark):
    rows = [(i, f'so token = "{HEX[i % 20:]}{i:04d}" ends', "src") for i in range(60)]
    rows += [(100 + i, f"card 41111111{i:08d} and page-of-words-{i:03d} here", "src") for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_forest_removes_false_positives(spark):
    rows = secrets.scan(corpus(spark), learn_from=secrets.F.col("key") % 5 != 0).collect()
    assert len(rows) == 180
    assert all(r.is_secret == (r.doc_id < 100) and 0 <= r.score <= 1 for r in rows)


def test_labelled_findings_rule(spark):
    """Labels that say the opposite of the rule are what the forest learns."""
    docs = corpus(spark)
    places = secrets.candidates(docs).selectExpr("key", "place", "cast(key >= 100 as int) as label")
    rows = secrets.scan(docs, places.unionByName(places)).collect()
    assert all(r.is_secret == (r.doc_id >= 100) for r in rows)


def test_odd_rows(spark, odd_docs, no_docs):
    assert secrets.scan(odd_docs).count() == 0
    assert secrets.scan(no_docs).count() == 0
    one = spark.createDataFrame([(1, f"token={HEX}", None)], "doc_id long, text string, source string")
    assert [(r.doc_id, r.is_secret) for r in secrets.scan(one).collect()] == [(1, True)]


def test_copies_of_a_key_make_no_words_of_it(spark):
    key = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYzzzKEY"
    copied = [(i, f"token={key} here", "src") for i in range(1000)] + [(1000 + i, f"number {i} token={key}", "src") for i in range(9)]
    alone = [(2000 + i, f"the word bpxrficyzzzkey wjalrxutnfemi mdeng alone, {i // 50}", "src") for i in range(50)]  # one text
    docs = spark.createDataFrame(copied + alone, "doc_id long, text string, source string")
    rows = secrets.features(secrets.candidates(docs), docs).collect()
    assert len(rows) == 1009 and all(r.covered_part == 0 for r in rows)
    assert all(r.is_secret for r in secrets.scan(docs).collect())


def test_words_of_several_texts_cover_a_candidate(spark):
    docs = spark.createDataFrame(
        [(1, "see page-of-words-001", "a"), (2, "one page, many words", "a"), (3, "words of a page", "a")],
        "doc_id long, text string, source string",
    )
    (row,) = secrets.features(secrets.candidates(docs), docs).collect()
    assert row.covered_part > 0.5


def test_all_candidates_of_a_word(spark):
    other = "9855ae4fa49702326c"
    docs = spark.createDataFrame(
        [(1, f'a {{"id":"a1b2c3d4e5f6","token":"{HEX}","again":"{HEX}"}} end', "p"), (2, f"x?session=a1b2c3d4e5f6&token={other}", "p")],
        "doc_id long, text string, source string",
    )
    rows = secrets.candidates(docs).orderBy("key", "ordinal").collect()
    assert [(r.key, r.place, r.ordinal, r.finding) for r in rows] == [
        (1, 1, 0, "a1b2c3d4e5f6"), (1, 1, 1, HEX), (1, 1, 2, HEX), (2, 0, 0, "a1b2c3d4e5f6"), (2, 0, 1, other)
    ]
    assert rows[0].before.endswith('{"id":"') and rows[1].before == '","token":"' and rows[1].after == '","again":"'
    assert rows[2].after == "end" and rows[4].before == "&token="
    found = {(r.doc_id, r.ordinal): r.is_secret for r in secrets.scan(docs).collect()}
    assert len(found) == 5 and found[2, 1] and not found[2, 0]


def test_values_of_secret_names_need_no_digit(spark):
    docs = spark.createDataFrame(
        [(1, 'the password = "correcthorsebatterystaple" and so', "p"), (2, "api_key=ABCDEFGHIJKLMNOPqrstuvwxyz", "p"),
         (3, "token=Ab3dE5gH1jK end", "p"), (4, '{"secret": "p@ss-w0rd!x", "id": "plainwordsonly"}', "p"),
         (5, "Authorization: Bearer abcDEFghiJKL\nnext", "p"), (6, "the author: nobody, a token of love", "p"), (7, "pwd: \x01abcdefg", "p")],
        "doc_id long, text string, source string",
    )
    rows = secrets.candidates(docs).collect()
    assert sorted((r.key, r.finding) for r in rows) == [
        (1, "correcthorsebatterystaple"), (2, "ABCDEFGHIJKLMNOPqrstuvwxyz"), (3, "Ab3dE5gH1jK"), (4, "p@ss-w0rd!x"), (5, "abcDEFghiJKL"),
        (7, "\ufffdabcdefg"),
    ]
    assert not any(secrets.MARK in r.before + r.after for r in rows)
    found = {r.doc_id: r.is_secret for r in secrets.scan(docs).collect()}
    assert all(found[i] for i in (1, 2, 3, 4, 5))


def test_evidence_is_of_other_documents(spark):
    issued = "ghp_" + "aB3dE6gH9j" * 4
    docs = spark.createDataFrame(
        [(1, f'token = "{HEX}"', "p"), (2, f"leaked {HEX} here", "p"), (3, f"seen {issued} alone", "p"),
         (4, "card 4111111111111111 and 4111111111111112", "p"), (5, "build a1b2c3d4e5f6a7", "p"), (6, "build a1b2c3d4e5f6a7", "p"),
         (7, "once x1y2z3x1y2z3", "p")],
        "doc_id long, text string, source string",
    )
    described = secrets.features(secrets.candidates(docs), docs)
    labels = sorted((r.key, r.finding, r.label) for r in secrets.evidence_labels(described).collect())
    assert labels == [
        (2, HEX, 1.0), (3, issued, 1.0), (4, "4111111111111111", 0.0), (5, "a1b2c3d4e5f6a7", 0.0), (6, "a1b2c3d4e5f6a7", 0.0)
    ]
