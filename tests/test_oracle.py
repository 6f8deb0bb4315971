"""Every registered query against its SQL on the smallest tables; those without SQL must give rows."""

import os

import duckdb
import pytest

from cartorio.plans.catalogue import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return c


def plain(value):
    if value is None or value != value:
        return "~"
    return format(value, ".9g") if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF)
    rows, columns = got.collect(), sorted(got.columns)
    if name not in ORACLE_SQL:
        assert rows
        return
    want = con.sql(ORACLE_SQL[name])
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    assert sorted(tuple(plain(r[c]) for c in columns) for r in rows) == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
