"""Every core query with SQL against DuckDB, on the smallest tables."""

import datetime as dt
import math
from pathlib import Path

import duckdb
import pytest

from pagelens.plans import registry

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in SF.glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v.isoformat() if isinstance(v, dt.datetime) else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([plain(r[i]) for i in order]) for r in data)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, db, name):
    df = registry.queries()[name](spark, str(SF))
    rel = db.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(list(rel.columns), rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_other_queries_run(spark, name):
    assert registry.queries()[name](spark, str(SF)).count() >= 0
