import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        # names that operators might use inside, as a user's own columns
        T.StructField("row", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("a.b", T.StringType()),
    ]
)


@pytest.fixture
def docs_of(spark):
    """A documents table of (doc_id, text, source) rows, with more columns."""

    def make(rows):
        full = [(i, t, s, "r", "x", 7, 0.5, "y") for i, t, s in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty and long texts, copies, repeated rows and odd characters."""
    long = " ".join(f"word{i % 997}x{i}" for i in range(30_000))
    return [
        (1, "the  quick\tbrown fox jumps over the lazy dog today", "s1"),
        (2, "the quick brown fox jumps over the lazy dog today", "s2"),
        (3, None, "s1"),
        (4, "", None),
        (5, " ", "s2"),
        (6, long, "s1"),
        (7, long + " more", "s3"),
        (None, "the quick brown fox jumps over the lazy dog today", "s1"),
        (None, "alone and without a name", None),
        (9, "twice the same row in this table", "s2"),
        (9, "twice the same row in this table", "s2"),
        (10, "é 日本語 😀   x\x1cy", "s1"),
        (11, "x" * 20_000, "s1"),
        (12, "one", "s4"),
        (13, "ONE", "s4"),
    ]
