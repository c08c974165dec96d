"""The queries against their SQL in DuckDB."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

from corvidex.llm import queries

from ..test_catalogue import TABLES, rows


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    # Rows as they are: pandas would turn whole numbers beside nulls into fractions.
    ours, theirs = queries.QUERIES[name](spark, sf), con.sql(queries.SQL[name])
    assert rows(pd.DataFrame(map(tuple, ours.collect()), columns=ours.columns, dtype=object)) == rows(pd.DataFrame(theirs.fetchall(), columns=theirs.columns, dtype=object))
