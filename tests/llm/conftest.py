from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from a list of texts, or of (number, text); other columns are filled in."""

    def make(texts, partitions: int = 3, extra: bool = False):
        rows = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
        df = spark.createDataFrame([(i, t, "en", f"s{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(rows)], DOCS).repartition(partitions)
        if extra:  # columns whose names the operators use inside
            for name in ("shard", "docs", "rows", "bucket", "n_words", "key", "blob", "class_id", "doc", "node", "rep", "findings", "group", "score"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make
