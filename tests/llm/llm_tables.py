import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside
        T.StructField("size", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("row", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    def make(texts, ids=None, sources=None):
        ids = range(len(texts)) if ids is None else ids
        sources = ["a"] * len(texts) if sources is None else sources
        rows = [
            (i, t, None if k % 3 else "en", s, None if t is None else len(t), "x", None, "y", "z")
            for k, (i, t, s) in enumerate(zip(ids, texts, sources))
        ]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make


LONG = " ".join(f"word{i % 997} and{i % 89}" for i in range(60_000))


@pytest.fixture(scope="session")
def awkward(documents):
    """Nulls in every column, empty and very long texts, repeated rows and ids, ties."""
    texts = [None, "", " \n\t", "one", "one two", LONG, "b" * 500_000, "same text here " * 20, "same text here " * 20]
    texts += ["same text here " * 20, None, "a\x00b éè 中文 \U0001f600", "idiot " * 60, "x"]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 7, 8, None, 9, 10, None]
    return documents(texts, ids, ["a", None, "b", "", "a", "a", "b", "b", "b", None, None, "c", "d", "d"])
