import pytest
from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def pages(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from (doc_id, text) pairs."""
    def make(*pairs):
        return spark.createDataFrame([(i, t, "en", "s", None) for i, t in pairs], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and very long texts, repeated rows, clashing column names."""
    long = " ".join(f"w{i * 7919 % 1_000_003}" for i in range(60_000))
    rows = make_docs((1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b c d e"),
                     (5, "a b c d e"), (None, "x y z"), (None, "x y z"), (7, long),
                     (8, "é" * 5000), (9, "\x00 null byte"))
    return rows.withColumns({name: F.lit(1) for name in (
        "fp", "component_id", "n_words", "items", "open", "group", "address", "kept")})
