from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Build a documents frame from (id, text) or (id, text, source) rows."""

    def build(*rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build
