from __future__ import annotations

import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Build a documents table from (id, text[, lang[, source]]); extra columns clash with the operators' own names."""

    def build(rows, extra=False):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, "en", "s0")[:4] if len(row) < 4 else row
            full.append((doc_id, text, lang, source, len(text or "")))
        df = spark.createDataFrame(full, DOC)
        if extra:
            for name in ("row", "_row", "words", "_words", "n_words", "hash", "key", "doc", "owner", "kept", "size", "_text", "spans"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return build
