"""Every catalogue query against its SQL, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from flowtide import queries as q

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in values), key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("name", sorted(q.QUERIES))
def test_query(spark, duck, name):
    df = q.QUERIES[name](spark, SF)
    got = rows(df.columns, df.collect())
    want = duck.sql(q.ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert got == rows(want.columns, want.fetchall())


def test_every_query_has_sql():
    assert set(q.QUERIES) == set(q.ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_golden_counts(spark):
    e = q.events(spark, SF)
    n = {(r.op, r.origin): r["count"] for r in e.groupBy("op", "origin").count().collect()}
    assert n == {("insert", None): 1350, ("update", None): 971, ("delete", None): 133, ("delete", "update"): 45, ("insert", "update"): 45}
    assert e.agg({"seq": "max"}).first()[0] == 89


def test_entry(spark):
    assert entry.entry(spark).count() == 1367
