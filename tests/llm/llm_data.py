"""Rows, paths and fixtures of the tests in this folder (imported by name: a second ``conftest`` would hide the first)."""

import pytest

SF = "/root/testdata/sf0.001"
LONG = "word " * 30_000 + "Ünïcode tail\n" * 50

#: id, text, lang, source, n_chars and columns whose names operators use themselves.
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from here.", "en", "a", 1, "x", 1.0, 7),
    (2, "The quick brown fox jumps over the lazy dog and runs far away from here.", "en", "a", 1, "y", 2.0, 7),
    (3, None, "en", None, None, None, None, None),
    (4, "", None, "b", 0, "x", None, None),
    (5, LONG, "de", "b", 5, "x", 0.0, 1),
    (6, " \t\n ", "de", "b", 5, "x", 0.0, 1),
    (None, "a row without an id, call +1 (017) 555-7713 or mail bob.7@mail.example.com", "en", "b", 5, "x", 0.0, 1),
    (7, "repeated row 4539148803436467", "en", "b", 5, "x", 0.0, 1),
    (7, "repeated row 4539148803436467", "en", "b", 5, "x", 0.0, 1),
    (8, "12345 67890 !!! ---", "en", "b", 5, "x", 0.0, 1),
    (9, "中文 текст ελληνικά", "xx", "b", 5, "x", 0.0, 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, score double, h int"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
