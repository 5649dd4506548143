"""Every registered catalogue query against its SQL twin in DuckDB, over the smallest tables."""

import math
import os

import duckdb
import pytest

from marquee import registry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if hasattr(v, "as_tuple") or isinstance(v, float):
        return None if math.isnan(float(v)) else round(float(v), 6)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_matches_sql(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    found = duck.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)
