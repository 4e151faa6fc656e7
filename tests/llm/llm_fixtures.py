"""Fixtures that the tests of this folder import."""

from __future__ import annotations

import random

import pytest

from llm.common import prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def tuned(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def awkward(tuned):
    """Nulls in every column, empty and long texts, repeated rows and ids, and columns with clashing names."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    long = " ".join(rng.choice(words) for _ in range(60_000))
    rows = [
        (1, "a b c d e f g", "en", "s", 13),
        (1, "a b c d e f g", "en", "s", 13),
        (2, "a b c d e f g", None, None, None),
        (3, None, "en", "s", None),
        (4, "", "en", "s", 0),
        (5, " \n\t ", "en", "s", 4),
        (6, long, "en", "s", len(long)),
        (7, "naïve café\u00a0x \n\n y ", "fr", "s", 20),
        (None, "only text", "en", "s", 9),
        (None, None, None, None, None),
        (8, "x" * 5000, "en", "s", 5000),
        (9, "é" * 450, "en", "s", 450),
    ]
    docs = tuned.createDataFrame(rows, DOCS)
    extra = {c: 1 for c in ("n_words", "score", "start", "node", "key", "row1", "first", "label", "ids")}
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit(v) for c, v in extra.items()})


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def labels(tuned):
    rows = [(1, 1, 0), (2, 1, None), (4, 0, 0), (6, None, 1), (None, 1, 1), (1, 1, 0)]
    return tuned.createDataFrame(rows, "doc_id long, quality int, toxic int")
