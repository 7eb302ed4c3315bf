import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Nulls in every column, empty and blank texts, a long text, ties and repeated rows.
ODD = [
    (1, "a b c d e f g h i j k l", "en", "s", 23),
    (1, "a b c d e f g h i j k l", "en", "s", 23),
    (2, "", "en", "s", 0),
    (3, None, None, None, None),
    (4, " \t\n ", "de", "é", 4),
    (None, "a b c d e f g h i j k l", "en", None, 23),
    (5, "word " * 20_000, "fr", "z", 100_000),
    (6, "x", "fr", "z", 1),
    (2**60 + 1, "line one here\nline two here\nline one here", "en", "s", 41),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
