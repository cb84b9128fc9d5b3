"""Every query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from scquarry.plans import catalog

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for f in os.listdir(DIR):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{f}'")
    return c


def same(a: pd.DataFrame, b: pd.DataFrame) -> None:
    assert sorted(a.columns) == sorted(b.columns)
    text = lambda v: "" if pd.isna(v) else f"{float(v):.6g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v).removesuffix("+00:00")
    norm = lambda f: sorted(tuple(text(v) for v in r) for r in f[sorted(f.columns)].astype(object).itertuples(index=False))
    assert norm(a) == norm(b)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, con, name):
    same(catalog.QUERIES[name](spark, DIR).toPandas(), con.sql(catalog.SQL[name]).df())


def test_entry_and_names(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0


def test_fingerprints_agree(spark):
    assert tuple(catalog.QUERIES["fingerprint_equal"](spark, DIR).first()) == (True, True)
