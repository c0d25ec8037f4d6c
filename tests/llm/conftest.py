from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

# What any table of documents may hold: NULLs everywhere, empty and blank texts, rows twice, one long text.
ODD = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", "de", None, 4), (4, "same text twice over and over", None, "b", None),
    (4, "same text twice over and over", None, "b", None), (None, "a row without an id", "en", "b", 19), (None, None, None, None, None),
    (5, "Ünïcödé 漢字 text 🙂 " * 40, "de", "c", 1000), (6, "word " * 30000, "en", "a", 150000),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
