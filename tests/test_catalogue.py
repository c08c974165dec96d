"""Every query of the catalogue against its SQL in DuckDB."""

from __future__ import annotations

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from corvidex.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


def rows(df: pd.DataFrame) -> list[tuple]:
    def cell(x):
        if x is None or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
            return "null"
        return repr(float(x)) if isinstance(x, float) else str(x)

    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_equals_sql(spark, duck, sf, name):
    assert rows(catalogue.QUERIES[name](spark, sf).toPandas()) == rows(duck.sql(catalogue.SQL[name]).df())


def test_queries_without_sql(spark, sf):
    for name in set(catalogue.QUERIES) - set(catalogue.SQL):
        assert catalogue.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_plans(spark, sf):
    """Lanes need no join, and the scan reads the columns that count."""
    plan = spark._jvm.PythonSQLUtils.explainString(catalogue.QUERIES["lane_triage"](spark, sf)._jdf.queryExecution(), "formatted")
    assert "Join" not in plan
    assert "p_retailprice" in plan and "p_brand" not in plan
    plan = spark._jvm.PythonSQLUtils.explainString(catalogue.QUERIES["manifest_last_wins"](spark, sf)._jdf.queryExecution(), "formatted")
    assert "WindowGroupLimit" in plan
