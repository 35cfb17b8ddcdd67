from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table from (doc_id, text) or full rows."""
    def make(rows, extra=""):
        full = [tuple(r) if len(r) > 2 else (r[0], r[1], "en", "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS + extra)
    return make


@pytest.fixture(scope="session")
def small_documents(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/documents.parquet")
