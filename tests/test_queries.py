"""Every panel query against its SQL on the smallest tables."""

import datetime as dt
import os

import duckdb
import pytest

from tidemark.plans.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def norm(v):
    if v is None or v != v:
        return ""
    if isinstance(v, (dt.date, dt.datetime)):
        return str(v)[:10]
    return f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in ("region", "nation", "supplier", "orders", "lineitem"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables aren't here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    got = QUERIES[name](spark, SF)
    rel = db.sql(ORACLES[name])
    cols = sorted(got.columns)
    assert cols == sorted(rel.columns)
    want = [tuple(norm(r[rel.columns.index(c)]) for c in cols) for r in rel.fetchall()]
    have = [tuple(norm(r[c]) for c in cols) for r in got.collect()]
    assert sorted(have) == sorted(want)
