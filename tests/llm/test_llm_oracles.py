"""Queries with SQL against DuckDB at sf0.001."""

import os

import duckdb
import pytest

from terracube.llm.oracles import ORACLES
from terracube.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return c


def norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = con.sql(ORACLES[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    assert got == sorted((tuple(norm(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert got
