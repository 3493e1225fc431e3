"""Fixtures and rows that all tests of the training-data operators share."""

from __future__ import annotations

import pytest

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(autouse=True)
def shipped(spark):
    """Python workers can import the package."""
    from tallyroom.llm.queries import ship

    ship(spark)


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text), with columns whose names the operators use themselves."""

    def make(*rows):
        full = [(i, t, "en", "s", None if t is None else len(t), 1.5, "x", 7, "y") for i, t in rows]
        return spark.createDataFrame(
            full,
            "doc_id long, text string, lang string, source string, n_chars long, "
            "_score double, text_ string, row_ int, secret_spans string",
        )

    return make


LONG = " ".join(f"w{i % 997}x{i}" for i in range(20_000))
ODD = [(None, None), (None, "no id here"), (1, None), (2, ""), (3, " \t\n "), (4, LONG), (5, "same row"), (5, "same row"), (5, "same id")]
