"""Every registered query against its SQL on the smallest driver tables."""

import math
import os

import duckdb
import pytest

from heliograph.plans import catalog

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS FROM '{DATA}/{f}'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else round(float(v), 4) if isinstance(v, float) or type(v).__name__ == "Decimal" else tuple(v) if isinstance(v, list) else v
    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, name):
    got = catalog.QUERIES[name](spark, DATA)
    mine = rows(got.columns, [tuple(r) for r in got.collect()])
    if name not in catalog.ORACLE:
        assert got.columns
        return
    rel = db.sql(catalog.ORACLE[name])
    assert sorted(rel.columns) == sorted(got.columns)
    theirs = rows(rel.columns, rel.fetchall())
    assert len(mine) == len(theirs)
    assert mine == theirs or close(mine, theirs)


def close(a, b):
    return all(len(x) == len(y) and all(p == q or isinstance(p, float) and isinstance(q, float) and abs(p - q) <= 2e-4 for p, q in zip(x, y)) for x, y in zip(a, b))
