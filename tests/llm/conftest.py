"""Tables that hold what every operator has to cope with."""

from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, chunk string, host string, line string"
PAGES = "page_id long, url string, html string, sha256 string, payload string"


def rows_of(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def make_documents(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use inside."""

    def make(*pairs, source="s"):
        rows = [(i, t, "en", source, None if t is None else len(t), "x", "y", None) for i, t in pairs]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def make_pages(spark):
    def make(*rows):
        return spark.createDataFrame([(i, u, h, "x", None) for i, u, h in rows], PAGES)

    return make
