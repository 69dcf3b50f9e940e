import pytest
from pyspark.sql import Row

SF_DIR = "/root/testdata/sf0.001"
LONG = "word " * 60_000


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, and columns that clash with those of operators."""
    texts = [None, "", "   \n\t ", LONG, "The cat sat on the mat.", "The cat sat on the mat.", "日本語 テキスト", None]
    ids = [1, 2, 3, 4, 5, 5, None, None]
    rows = [
        Row(doc_id=i, text=t, lang="en" if t else None, source=None, n_chars=len(t or ""), ids="x", decoded="x", score="x",
            lang_pred="x", kept="x", n_words="x", n_replaced="x", row_key="x", place="x", n_tokens="x", key="x")
        for i, t in zip(ids, texts, strict=True)
    ]
    schema = ("doc_id long, text string, lang string, source string, n_chars long, ids string, decoded string, score string, "
              "lang_pred string, kept string, n_words string, n_replaced string, row_key string, place string, n_tokens string, "
              "key string")  # fmt: skip
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
