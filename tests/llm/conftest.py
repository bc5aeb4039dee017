from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"

#: Odd rows: nulls, an empty text, white space only, copies, a repeated row, a long text, columns with clashing names.
LONG = "the word " * 30_000
ODD = [
    (1, "One fine day, the text began.", "en", "a", 1, 0.5, "x"),
    (2, "One fine day, the text began.", "en", "a", 1, 0.5, None),
    (2, "One fine day, the text began.", "en", "a", 1, 0.5, None),
    (3, None, None, None, None, None, None),
    (4, "", "en", "a", 0, 0.1, "y"),
    (5, " \t\n", "de", "b", 3, 0.1, "z"),
    (6, "Ünïcode – \U0001f600 “quoted”\nline", "de", "b", 9, 0.1, "z"),
    (7, LONG, "en", "c", len(LONG), 0.1, "z"),
    (8, LONG + "end", "en", "c", len(LONG), 0.1, "z"),
    (9, "word", "fr", None, 4, 0.1, "z"),
    (None, "a text without an id", "fr", "c", 4, 0.1, "z"),
]
ODD_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, "
              "component_id string")


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, ODD_SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
