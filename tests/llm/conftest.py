from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Make a table of documents from (id, text) or (id, text, lang, source) rows, with clashing extra columns."""

    def make(rows, extra: bool = True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(3)
        if not extra:
            return df
        return df.selectExpr("*", "1 AS kept", "'x' AS words", "2L AS component_id", "'y' AS found", "3 AS piece", "'r' AS row")

    return make


EDGE_ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "word"), (5, "word"), (None, "no id at all"),
    (6, None, None, None), (7, "long " * 60_000), (8, "éà ñ 日本"),
]


@pytest.fixture
def edge_rows():
    return list(EDGE_ROWS)
