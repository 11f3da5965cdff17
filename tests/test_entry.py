"""Driver contract: entry() runs; every query has a DuckDB twin that agrees (sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from docsift import catalog, oracle_sql
from docsift.sources.tables import TABLES

from sf_paths import SF_SMALL

NO_SQL_TWIN = {"rules_documents"}   # checked by tests/test_documents_bruteforce.py
SQL = oracle_sql.oracle_sql()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["job_id", "ord", "field", "value", "source"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) - set(SQL) == NO_SQL_TWIN
    assert set(SQL) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    return float(f"{v:.9g}") if isinstance(v, float) and not math.isnan(v) else v


def _sorted(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = con.sql(SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _sorted(df.collect(), df.columns) == _sorted(rel.fetchall(), rel.columns)
