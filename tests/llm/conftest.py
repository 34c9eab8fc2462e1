import pytest

ODD = [
    (1, "The quick brown fox jumps over the lazy dog, again and again.", "en", "a", 61),
    (2, "The quick brown fox jumps over the lazy dog, again and again.", "en", "a", 61),
    (2, "The quick brown fox jumps over the lazy dog, again and again.", "en", "a", 61),
    (3, None, "en", None, None),
    (4, "", None, "b", 0),
    (5, " \n\t ", "de", "b", 4),
    (6, "Der schnelle braune Fuchs springt über den faulen Hund. 漢字 😀", "de", "c", 62),
    (None, "no identifier here", None, "c", 18),
    (7, "x" * 5000, "en", "a", 5000),
    (8, "word " * 3000, "en", "a", 15000),
    (9, "123 456 ?!", "fr", "a", 10),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and an extra column with a clashing name."""
    from pyspark.sql import functions as F

    return spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit("mine"))


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
