from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars int, id int, row string, hash string, norm string, removed int"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang, source]); columns that operators use inside are there as well."""

    def make(rows):
        full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "s")), len(r[1] or ""), 7, "r", "h", "n", 1) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids."""
    long = " ".join(f"word{i % 997}" for i in range(60_000))
    return make_docs([
        (1, "A b\tc  d."), (2, "A b c d."), (3, None, None, None), (4, ""), (5, " \n\t "), (None, "A b c d."), (None, None),
        (6, long), (7, long + " end"), (8, "A b c d."), (8, "A b c d."), (8, "something else"), (9, "héllo wörld 日本 😀"),
    ])


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
