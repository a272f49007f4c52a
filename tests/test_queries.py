"""Registered queries of the reference operators against DuckDB, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from arrayloom.plans.registry import FLAGSHIP, ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.sql("SET timezone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS FROM '{sf}/{t}.parquet'")
    return con


def rows(df):
    df = df[sorted(df.columns)].astype(object).where(df.notna(), None)

    def cell(v):
        if v is None or v is pd.NA:
            return "NULL"
        return str(v) if isinstance(v, str) else f"{float(v):.5f}"

    return sorted(tuple(map(cell, r)) for r in df.to_numpy().tolist())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, duck, sf, name):
    got, want = QUERIES[name](spark, sf).toPandas(), duck.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry_imports():
    import __spark_entry__ as entry

    assert FLAGSHIP in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())
