"""Every registered query against its DuckDB SQL on the smallest tables, whole."""

import math
import os

import pytest

from readloom.plans import registry

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, bool):
        return str(v)
    try:
        return "None" if v is None or math.isnan(v) else f"{float(v):.6f}"
    except TypeError:
        return str(v)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.sql(f"create view {t.split('.')[0]} as select * from '{SF}/{t}'")
    got = registry.QUERIES[name](spark, SF)
    want = con.sql(registry.ORACLES[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    mine = sorted(tuple(plain(r[c]) for c in cols) for r in got.collect())
    place = [want.columns.index(c) for c in cols]
    assert mine == sorted(tuple(plain(r[k]) for k in place) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_sql(spark, name):
    assert len(registry.QUERIES[name](spark, SF).collect()) > 0
