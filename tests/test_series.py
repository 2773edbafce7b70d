"""Folds in parts against the folds that take a key whole, on one key that has all rows."""

import random

import pytest
from pyspark.sql import functions as F

from loamstack.operators import sampling, series


def runs_of(spark, n, keys, seed=1):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(keys), i // 2, rnd.uniform(-1, 1), rnd.uniform(-1, 1), rnd.random() < 0.01) for i in range(n)]
    return spark.createDataFrame(rows, "id long, run string, t long, reward double, value double, done boolean"), rows


@pytest.mark.parametrize("keys", [["a"], ["a", "b", None]])
def test_advantages(spark, keys):
    df, rows = runs_of(spark, 3000, keys)
    out = series.advantages(df, ["run"], ["t", "id"], part_rows=100)
    got = {r["id"]: r["advantage"] for r in out.collect()}
    assert out.columns == [*df.columns, "advantage"] and len(got) == 3000
    step = F.struct("t", "id", "reward", "value", "done")
    whole = df.groupBy("run").agg(F.array_sort(F.collect_list(step)).alias("xs")).select(F.explode(F.arrays_zip(F.col("xs.id"), sampling.advantages(F.col("xs")))).alias("x"))
    assert all(abs(got[r["x"][0]] - r["x"][1]) < 1e-9 for r in whole.collect())
    placed = series.placed(df, ["run"], ["t", "id"], 100)
    assert placed.select("_part").distinct().count() >= 20 and placed.groupBy("_part").count().agg(F.max("count")).first()[0] < 500


@pytest.mark.parametrize("density", [1, 40, 5000])
def test_cooldowns(spark, density):
    """Rows far apart, some in each cooldown, and very many, with equal times."""
    rnd = random.Random(density)
    rows = [(i, "k" if i % 5 else None, rnd.randrange(0, 300 * 1200 // density)) for i in range(1200)]
    df = spark.createDataFrame(rows, "id long, k string, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = sorted((str(r["k"]), r["s"]) for r in series.after_cooldown(df, ["k"], "ts", 300, part_rows=50).collect())
    want = []
    for k in ("k", None):
        last = None
        for s in sorted(s for _, key, s in rows if key == k):
            if last is None or s - last >= 300:
                want.append((str(k), s))
                last = s
    assert got == sorted(want)


@pytest.mark.parametrize("limits", [(500, 8), (10_000, 5), (1, 100), (500, 64)])
def test_batches(spark, limits):
    rnd = random.Random(3)
    rows = [(i, "big" if i % 9 else None, rnd.choice([0, 1, 5, rnd.randrange(400), 900])) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, g string, n int")
    for group in ("g", None):
        got = {r["id"]: r["batch"] for r in series.length_batches(df, "id", "n", *limits, group, part_rows=64).collect()}
        want = {r["id"]: r["batch"] for r in sampling.length_batches(df, "id", "n", *limits, group).collect()}
        assert got == want
    assert series.length_batches(df.limit(0), "id", "n", 5, 5).count() == 0
