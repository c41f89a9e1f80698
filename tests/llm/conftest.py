import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("score", T.StringType()),  # a name that operators use, too
        T.StructField("id", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) rows, with extra columns of clashing names."""

    def make(rows):
        return spark.createDataFrame([(i, t, None, "x", 7) for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def odd(docs_of):
    """Nulls, empty and blank texts, ties, repeated rows, a very long text."""
    long = "lorem ipsum dolor sit amet " * 20_000
    return docs_of(
        [(1, None), (2, ""), (3, "  \n\t"), (4, "a b"), (4, "a b"), (5, "a b"), (None, "a b")]
        + [(None, "lone"), (6, long), (7, long), (8, "É È ÜBER naïve …"), (9, "x")]
    )


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
