"""Relational queries over all rows, against their SQL and the tables' counts."""

import duckdb
import pytest

from loamstack.plans import registry

FOLDER = "/root/testdata/sf0.001"


def table(name):
    return f"'{FOLDER}/{name}.parquet'"


def compare(spark, duck, name):
    got, want = registry.QUERIES[name](spark, FOLDER), duck.execute(registry.ORACLES[name])
    columns = [c[0] for c in want.description]
    rows = want.fetchall()
    assert sorted(tuple(map(str, (r[c] for c in columns))) for r in got.collect()) == sorted(tuple(map(str, r)) for r in rows)
    return rows


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("customer", "supplier", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM {table(name)}")
    return con


def test_full_join_reads_every_row(spark, duck):
    rows = compare(spark, duck, "rel_full_join_whole")
    pairs = duck.execute("SELECT count(*) FROM customer FULL JOIN supplier ON c_nationkey = s_nationkey").fetchone()[0]
    assert sum(r[-1] for r in rows) == pairs


def test_full_join_counts_null_keys_and_lone_nations(spark, tmp_path):
    con = duckdb.connect()
    tables = {"customer": (("c_custkey", "c_nationkey"), [(1, 1), (2, 1), (None, 1), (3, None), (4, 2)]), "supplier": (("s_suppkey", "s_nationkey"), [(1, 1), (2, 1), (3, None), (4, 3)])}
    for name, (columns, rows) in tables.items():
        spark.createDataFrame(rows, ", ".join(f"{c} long" for c in columns)).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.execute(registry.ORACLES["rel_full_join_whole"]).fetchall()
    assert sorted(map(str, map(tuple, registry.QUERIES["rel_full_join_whole"](spark, str(tmp_path)).collect()))) == sorted(map(str, want))


def test_unpivot_reads_every_row(spark, duck):
    rows = compare(spark, duck, "rel_unpivot_whole")
    assert len(rows) == 2 * duck.execute("SELECT count(*) FROM lineitem").fetchone()[0]
