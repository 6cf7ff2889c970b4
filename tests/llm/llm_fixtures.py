from __future__ import annotations

import pytest

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string"


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def make(rows, extra=False):
        whole = [(*r, *("en", "a")[len(r) - 2 :]) if len(r) < 4 else r for r in rows]
        df = spark.createDataFrame(whole, DOCS).repartition(3)
        if extra:  # names that an operator might use itself
            for name in ("row", "n", "size", "copies", "label", "path", "score", "h1", "kept", "a b"):
                df = df.selectExpr("*", f"concat('x', doc_id) as `{name}`")
        return df

    return make


def told(df, *columns):
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=repr)
