from __future__ import annotations

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """Rows (doc_id, text) or (doc_id, text, lang, source) as a documents table, with a clashing extra column."""

    def make(rows, extra: str = "copy string"):
        full = [(*(list(r) + [None] * (4 - len(r))), None if r[1] is None else len(r[1]), "x") for r in rows]
        return spark.createDataFrame(full, f"{DOC_SCHEMA}, {extra}")

    return make
