import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty and blank texts, repeated rows, one very long text."""
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \n\t ", "en", None, 4),
        (4, "same text of a few words to be told apart from others", "en", "a", 1),
        (5, "same text of a few words to be told apart from others", "en", "a", 1),
        (5, "same text of a few words to be told apart from others", "en", "a", 1),
        (None, "nobody's text with a few more words than five", None, "b", 1),
        (None, None, None, None, None),
        (6, "longer " * 40_000, "de", "b", 280_000),
        (-7, "ÄÖÜ ß 🙂 a@b.example.com +1 (555) 555-1234 10.0.0.1", "de", "b", 1),
        (9_000_000_000, "x" * 100_000, "fr", "c", 100_000),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(odd):
    """Extra columns with names that operators might want for themselves."""
    from pyspark.sql import functions as F

    extra = "contamination score predicted shard slot size block label words component_id h n".split()
    return odd.withColumns({name: F.lit("own") for name in extra}).withColumnRenamed("lang", "Lang")
