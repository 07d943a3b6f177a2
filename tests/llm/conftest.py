import pytest

DOCS = "doc_id long, text string, lang string, fp string, source string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows and a column with a clashing name."""
    word = "alpha beta gamma delta epsilon zeta eta theta "
    rows = [
        (1, word * 3, "en", "x", "s"), (2, word * 3, "en", None, "s"), (2, word * 3, "en", None, "s"), (3, None, None, "x", None), (4, "", "en", "x", "s"),
        (5, "été à Noël " * 40, "fr", "x", "s"), (6, "Ünïcode 漢字 12 !?", None, "x", "s"), (7, word * 3000, "en", "x", "s"), (8, " \t\n ", "en", "x", "s"), (None, "no id here", "en", "x", "s"), (10, "x", "fr", "x", "s"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
