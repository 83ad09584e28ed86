from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # extra columns whose names clash with ones the operators use inside
    T.StructField("rid", T.StringType()), T.StructField("digest", T.StringType()),
    T.StructField("key", T.StringType()), T.StructField("keep_id", T.StringType()),
])


@pytest.fixture
def make_docs(spark):
    def make(rows):
        data = [(d, t, "en", "src", None if t is None else len(t), "x", "x", "x", "x") for d, t in rows]
        return spark.createDataFrame(data, DOCS)
    return make


@pytest.fixture(scope="session")
def some_docs(spark):
    """Whole texts of the small documents table as (doc_id, text)."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


ODD = [
    (1, None), (2, ""), (3, "   "), (4, "\n\n a\t b \n"), (5, "word"), (6, "long " * 20_000),
    (7, "é▁ 😀 ß x"), (8, "x" * 3_000), (5, "word"), (None, "no id"), (None, None), (9, "a b c d e f g h"),
]
