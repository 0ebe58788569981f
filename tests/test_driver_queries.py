"""Every query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from ledgerline.plans import driver_queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    d = duckdb.connect()
    for t in TABLES:
        d.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return d


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(driver_queries.queries()))
def test_query(spark, duck, name):
    df = driver_queries.queries()[name](spark, SF)
    rows = [tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()]
    sql = driver_queries.oracle_sql().get(name)
    if sql is None:
        return
    rel = duck.sql(sql)
    order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    want = [tuple(plain(r[i]) for i in order) for r in rel.fetchall()]
    assert sorted(rel.columns) == sorted(df.columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(rows, key=key) == sorted(want, key=key)
