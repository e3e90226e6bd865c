"""Small tables with every awkward row: nulls, empty and long texts, ties, repeats, clashing names."""

import os

import pytest
from cases import DOCS, prose


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


@pytest.fixture(scope="session")
def awkward(spark):
    """(doc_id, text) rows as a DataFrame with clashing extra columns, and as a list."""
    passage = prose(1, 120)
    rows = [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, " \n\t ", "en", "a"),
        (4, "One", "en", "b"),
        (5, "one two three four", "en", "b"),
        (6, "ONE two THREE four", "en", None),
        (7, passage, "en", "a"),
        (8, passage, "en", "a"),
        (8, passage, "en", "a"),
        (9, prose(2, 60) + " " + passage + " " + prose(3, 40), "fr", "b"),
        (10, "x" * 3000, "fr", "b"),
        (11, "ñandú größe 漢字 кот " * 80, "es", "c"),
        (12, "ñandú größe 漢字 кот " * 60 + prose(4, 300), "es", "c"),
        (13, prose(5, 20_000), "en", "a"),
        (14, "#!$ %% ...", None, "c"),
        (None, prose(6, 50), "en", None),
        (15, prose(7, 200), "en", "hot"),
        (16, prose(7, 200).replace("w1 ", "v1 "), "en", "hot"),
        (17, "the mit license, apache-license and CC BY; gnu general public license cc by cc by", "en", "hot"),
    ]
    full = [(i, t, lang, s, len(t or ""), 5, "s", "l", "k", "r") for i, t, lang, s in rows]
    return spark.createDataFrame(full, DOCS).repartition(3), [(i, t or "") for i, t, _, _ in rows]


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
