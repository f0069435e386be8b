from __future__ import annotations

import pytest
from hard_texts import TEXTS

@pytest.fixture(scope="session")
def hard_docs(spark):
    """Nulls, blanks, very long texts, ties, a repeated row, a null id and a repeated id, and
    columns that bear names the operators use themselves."""
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(6, TEXTS[6]), (None, "two words"), (5, "other")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.selectExpr(
        "doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars",
        "1 AS ids", "2 AS fingerprint", "3 AS `_key`", "4 AS n_words", "5 AS `a.b`", "6 AS lines_deleted",
        "7 AS decoded", "8 AS `_text`", "9 AS rule",
    ).coalesce(2)


@pytest.fixture(scope="session")
def no_docs(hard_docs):
    return hard_docs.limit(0)
