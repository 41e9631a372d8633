"""Every registered query against its DuckDB twin on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from vitalframe.sources.io import TABLES
from tests.conftest import SF001

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{os.path.join(SF001, t)}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    cur = con.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(dcols, cur.fetchall())


def test_every_query_of_the_catalog_has_an_oracle():
    from vitalframe.plans import catalog
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
