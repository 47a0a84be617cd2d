from __future__ import annotations

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from ``(doc_id, text)`` or ``(doc_id, text, lang)`` rows, with columns
    whose names the operators use inside."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        clashing = ["fp", "id", "text_hash", "score", "_id", "variant", "part", "attempts", "hash", "features", "label", "_hash", "_row", "own_host", "codes", "found", "replaced", "share", "rank"]
        return df.withColumns({c: F.lit(7) for c in clashing})

    return make
