"""Every registered query against its DuckDB oracle on sf0.001 (row count and values)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from terracube.queries import QUERIES

SF, SF_FITTED = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19].replace("T", " ")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


#: A fit is unique where it has more examples than inputs.
FITTED = {"ablation", "coef_top10"}


def connect(sf):
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.fixture(scope="module")
def cons():
    return {sf: connect(sf) for sf in (SF, SF_FITTED)}


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(E.oracle_sql())))
def test_query_matches_oracle(spark, cons, name):
    sf = SF_FITTED if name in FITTED else SF
    con, sdf = cons[sf], QUERIES[name](spark, sf)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert srows == drows


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["gb_year", "split", "n_examples", "mean_y"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())
