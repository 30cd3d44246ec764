"""Every registered query of the library against its SQL at the smallest scale."""

from __future__ import annotations

import os

import duckdb
import pytest

from strandline.plans import catalogue


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return [_plain(x) for x in value] if isinstance(value, (list, tuple)) else value


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in os.listdir(sf):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM read_parquet('{sf}/{name}')")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_sql(spark, sf, duck, name):
    got = catalogue.QUERIES[name](spark, sf)
    result = duck.execute(catalogue.ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(got.columns) == sorted(columns)
    order = sorted(columns)
    want = sorted(repr([_plain(r[columns.index(c)]) for c in order]) for r in result.fetchall())
    assert sorted(repr([_plain(r[c]) for c in order]) for r in got.collect()) == want


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_query_without_sql_runs(spark, sf, name):
    assert catalogue.QUERIES[name](spark, sf).count() > 0
