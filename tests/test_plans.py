"""Registered queries against their SQL on the smallest tables."""

import glob
import math
import os
from collections import Counter

import pytest

import __spark_entry__ as entry
from veldspar.plans import registry

duckdb = pytest.importorskip("duckdb")


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return round(v, 4) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def sql(small):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for f in glob.glob(f"{small}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_its_sql(spark, small, sql, name):
    df = registry.QUERIES[name](spark, small)
    r = sql.execute(registry.SQL[name])
    names = [x[0] for x in r.description]
    assert sorted(df.columns) == sorted(names)
    order = [names.index(c) for c in df.columns]
    want = Counter(tuple(plain(row[i]) for i in order) for row in r.fetchall())
    assert Counter(tuple(plain(v) for v in row) for row in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_query_without_sql_runs(spark, small, name):
    rows = registry.QUERIES[name](spark, small).collect()
    assert rows and len({(r["item_table"], r["item_id"]) for r in rows}) == len(rows)


def test_driver_contract(spark):
    assert entry.entry(spark).columns == ["item_table", "item_id", "canonical"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
