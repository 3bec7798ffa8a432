import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
AWKWARD = [
    None, "", " ", "one", "one two three", "x" * 5000, "wörter " * 400, "a\n\n b \tc\r\nd", "Same text twice. Same text twice.",
    "Same text twice. Same text twice.", "日本語のテキスト", "123 456", "it's we'll  they're \n\n ok ",
]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts or from (text, lang, source); ids count from 0."""

    def make(rows, start: int = 0):
        full = [r if isinstance(r, tuple) else (r, "en", "s0") for r in rows]
        data = [(start + i, t, lang, source, None if t is None else len(t)) for i, (t, lang, source) in enumerate(full)]
        return spark.createDataFrame(data, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def awkward(make_docs, spark):
    """Nulls in every column, empty and very long texts, repeated rows."""
    docs = make_docs(AWKWARD)
    odd = spark.createDataFrame([(None, "no id here at all", None, None, None), (3, "one", "en", "s0", 3)], DOCUMENTS)
    return docs.unionByName(odd)
