import pytest

from tests.conftest import SF_SMALL, spark  # noqa: F401


@pytest.fixture()
def make(spark):  # noqa: F811
    def of(rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
        return spark.createDataFrame(rows, schema)
    return of


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL


#: Null columns, empty, blank and very long texts, ties, repeated rows.
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", "b", 4),
    (4, "word " * 40_000, "en", "a", 200_000),
    (5, "one two three four five six seven eight nine ten", "en", "a", 48),
    (5, "one two three four five six seven eight nine ten", "en", "a", 48),
    (6, "one two three four five six seven eight nine ten", None, "b", 48),
    (7, "é" * 3000, "fr", None, 3000),
]
