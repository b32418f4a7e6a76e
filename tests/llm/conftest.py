import pytest


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.fixture
def awkward(spark):
    """Nulls, empty and very long texts, repeated rows, ties, and columns that clash with results."""
    long = " ".join(f"word{k % 977}" for k in range(60_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog", "en", "a", 1.0, "x"),
        (1, "The quick brown fox jumps over the lazy dog", "en", "a", 1.0, "x"),
        (2, None, None, None, None, None),
        (3, "", "en", None, None, None),
        (None, "Une phrase sans nom, mais pas sans mots", "fr", "b", None, "y"),
        (4, long, "en", "b", None, None),
        (5, " \t\n ", None, "a", None, None),
        (6, "12345 !!! 678", None, "c", None, None),
    ]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, score double, spans string"
    )
