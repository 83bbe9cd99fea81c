"""Small tables with the odd cases that every operator must take."""

from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids, texts and sources, empty and very long texts, ties and repeated rows, and columns whose
    names operators might use themselves."""
    long = " ".join(f"word{k % 977}" for k in range(60_000))
    rows = [
        (1, "Alpha beta gamma delta epsilon zeta.", "en", "a", 1),
        (2, "Alpha  beta gamma\ndelta epsilon zeta.", "en", "b", 1),
        (2, "Alpha  beta gamma\ndelta epsilon zeta.", "en", "b", 1),
        (3, None, "en", "a", 0), (4, "", None, None, 0), (5, " \t\n", "en", None, 3),
        (6, long, "en", "c", 1), (7, long, "en", "c", 1),
        (None, "a text without an id", None, "a", None), (None, None, None, None, None),
        (8, "\x00 é é \U0001f600 <|endoftext|>", "fr", "a", 9),
    ]
    made = spark.createDataFrame(rows, DOCS)
    clash = "size target score row text_sha256 keep_id n node band comp component_id place range mark kind".split()
    from pyspark.sql import functions as F

    return made.withColumns({c: F.lit("clash") for c in clash})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
