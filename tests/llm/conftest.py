import pytest
from pyspark.sql import Row  # noqa: F401

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache()


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing names."""
    long = " ".join(f"w{i % 977}" for i in range(60000))
    rows = [(1, "a b c d e f", "s", 1), (1, "a b c d e f", "s", 1), (2, None, None, 2), (None, "a b c d e f", "s", 3),
            (3, "", "", None), (4, "one", "t", 1), (5, long, "s", 1), (6, " \t\n ", None, 1), (None, None, None, None),
            (7, "mail me a.b@c.de or +1 (222) 333-4444é\U0001f600 10.0.0.256 10.0.0.25", "t", 5), (3, "", "", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, id long")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
