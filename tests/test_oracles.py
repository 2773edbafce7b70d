"""A sample of the queries against their SQL in DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from loamstack.plans import registry

FOLDER = "/root/testdata/sf0.001"
NAMES = sorted(registry.ORACLES)[::4]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if v is None or v != v:
        return "null"
    if isinstance(v, bool):
        return str(v)
    return f"{float(v):.6f}" if isinstance(v, (int, float)) or hasattr(v, "as_integer_ratio") else str(v)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, FOLDER)
    want = duck.execute(registry.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert set(columns) == set(got.columns)
    a = sorted(tuple(plain(r[c]) for c in columns) for r in got.collect())
    b = sorted(tuple(plain(v) for v in r) for r in want.fetchall())
    assert a == b
