"""Tables and fixtures of these tests; test modules import what they use."""

import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def some_docs(spark):
    """(doc_id, text, source) of the smallest given table."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source").collect()
    return [tuple(r) for r in rows]
