import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, rank int, bucket int, _row string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    long = " ".join(f"w{i % 977}x" for i in range(30_000))
    secret = 'token = "abcdefgh12345678"'
    rows = [(1, "one two three four five", "en", "a"), (1, "one two three four five", "en", "a"), (2, None, None, None), (3, "", "en", "b"), (None, "no id here at all", "en", "a"), (None, None, None, None), (4, long, "en", "a"),
            (5, secret + " and more words", "en", "b"), (6, "one two three four five", "de", "c"), (7, "  \t\n ", "en", "c"), (8, "Ünïcödé ²½ \U0001f600 漢字 words", "en", "b"), (8, "same id, other text", "en", "b"), (9, "a\x00b\x01c", "en", "a")]
    return spark.createDataFrame([(i, t, g, s, None if t is None else len(t), 7, 3, 1, "x") for i, t, g, s in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
