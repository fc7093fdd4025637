"""Small document tables for the corpus operators."""

from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """A function: rows (doc_id, text[, source]) to a documents table, with columns
    whose names clash with those of results."""

    def make(rows, clash: bool = True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if clash:
            from pyspark.sql import functions as F

            df = df.withColumns({c: F.lit("x") for c in ("score", "predicted", "held_out", "size", "target", "taken", "fp", "ids", "n_tokens", "start", "part", "key", "component_id", "label")})
        return df

    return make


#: Nulls, empty and blank texts, repeated rows, a shared id, a long text.
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "a b c d"), (4, "a b c d"), (None, "a b c d"), (None, None), (5, "word " * 30_000), (6, "Ünï — 日本 \u00a0 x"), (4, "other text"), (7, "a")]


@pytest.fixture
def odd():
    return ODD
