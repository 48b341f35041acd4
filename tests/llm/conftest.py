import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls in every column, empty and blank texts, repeated rows and ids, one very long text.
ODD = [
    (0, None, None, None, None),
    (1, "", "en", "a", 0),
    (2, " \n\t ", "en", "a", 4),
    (3, "one two three", "en", None, 13),
    (3, "one two three", "en", None, 13),
    (None, "a text that has no id at all but is long enough to be kept.", "en", "a", 59),
    (4, "x" * 300_000, "en", "a", 300_000),
    (5, "word " * 60_000, "en", "a", 300_000),
    (6, "é日本 \U0001f600 \x00 ok", "en", "a", 10),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with extra columns whose names clash with those that operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, COLUMNS)
    return df.withColumns({c: F.lit("x") for c in ("_id", "id", "text_", "node", "component", "host", "path", "block", "score", "kept", "n_words", "file", "row", "_row", "digest", "sig")})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)
