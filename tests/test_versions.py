"""Versioned tables and configurations, first sights by Bloom filters, and runs with a bad source, against plain versions."""

import random
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamstack.operators.versions import Configs, Conflict, Log, VersionedTable
from loamstack.sources import runs
from loamstack.streaming import seen, streams, timed

SCHEMA = "k long, word string, tags map<string,string>"
CHANGE = SCHEMA + ", seq long, gone boolean"


def _rows(t, version=None):
    return {r["k"]: (r["word"], r["tags"]) for r in t.read(version).collect()}


def test_commits_equal_a_dictionary(spark, tmp_path):
    rng = random.Random(3)
    t = VersionedTable(spark, f"file://{tmp_path}/t")
    state = {k: (f"w{k}", {"a": str(k)}) for k in [*range(200), None]}
    t.create(spark.createDataFrame([(k, *v) for k, v in state.items()], SCHEMA), ["k"], ["word"], 8)
    want = [state]
    for _ in range(3):
        now, changes, seq = dict(want[-1]), [], 0
        for _ in range(60):
            # a third of all changes are those of one key; one key is null
            k, seq = rng.choice([7, 7, None, rng.randrange(300), rng.randrange(300)]), seq + 1
            gone = rng.choice([True, False, None])
            changes.append((k, f"c{seq}", None, seq, gone))
            changes.append(changes[-1])
            if gone:
                now.pop(k, None)
            else:
                now[k] = (f"c{seq}", None)
        before = len(want[-1].keys() - now.keys())
        number = t.commit(spark.createDataFrame(changes, CHANGE), ["seq"], F.col("gone"))
        want.append(now)
        assert _rows(t) == now
        assert t.log.read(number)["removed"] == before
    assert t.restore(2) == 5
    for version, state in enumerate([*want, want[1]], 1):
        assert _rows(t, version) == state
    assert [r["operation"] for r in t.history().orderBy("version").collect()] == ["create", "commit", "commit", "commit", "restore"]


def test_only_touched_buckets_are_written(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t")
    t.create(spark.range(400).select(F.col("id").alias("k"), F.lit("x").alias("word")), ["k"], ["word"], 16)
    assert t.commit(spark.createDataFrame([(5, "new"), (999, "more")], "k long, word string"), ["word"]) == 2
    a, b = t.log.read(1), t.log.read(2)
    moved = {k for k in b["buckets"] if a["buckets"].get(k) != b["buckets"][k]}
    assert moved == {str(x) for x in b["touched"]} and 1 <= len(moved) <= 2
    opened = {f.split("/data/")[1].split("/part")[0] for f in t.read().inputFiles()}
    assert sum(f.split("/")[0] == a["buckets"]["0"] for f in opened) == 16 - len(moved)
    assert t.commit(spark.createDataFrame([], "k long, word string"), ["word"]) == 2  # nothing to do, no version
    assert t.commit(t.read(), ["word"], F.lit(True)) == 3 and t.read().count() == 0
    assert t.commit(spark.createDataFrame([(1, "back")], "k long, word string"), ["word"]) == 4 and t.read().count() == 1


def test_two_writers(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t")
    t.create(spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("word")), ["k"], ["word"], 16)
    one = lambda k, w: spark.createDataFrame([(k, w)], "k long, word string")
    home = {r["k"]: r["b"] for r in t.read().select("k", F.pmod(F.xxhash64("k"), F.lit(16)).alias("b")).collect()}
    same, other = next(k for k in range(2, 100) if home[k] == home[1]), next(k for k in range(2, 100) if home[k] != home[1])
    assert t.commit(one(1, "a"), ["word"], base=1) == 2
    with pytest.raises(Conflict):
        t.commit(one(same, "b"), ["word"], base=1)
    assert t.commit(one(other, "c"), ["word"], base=1) == 3
    got = {r["k"]: r["word"] for r in t.read().collect()}
    assert (got[1], got[other], got[same]) == ("a", "c", "x") and len(got) == 100
    with pytest.raises(Conflict):
        t.create(one(1, "z"), ["k"], ["word"])


def test_a_number_is_put_once(spark, tmp_path):
    log, configs = Log(spark, f"file://{tmp_path}/a log"), Configs(spark, f"file://{tmp_path}/c")
    assert log.last() == 0 and configs.load() is None
    with ThreadPoolExecutor(8) as pool:
        assert sum(pool.map(lambda n: log.put(1, {"n": n}), range(8))) == 1
        assert sorted(pool.map(lambda n: configs.save({"b": n, "a": 1}), range(8))) == list(range(1, 9))
    assert configs.rollback(3) == 9 and configs.load() == configs.load(3)
    assert configs.log.read(9)["digest"] == configs.log.read(3)["digest"]
    assert not [p for p in (tmp_path / "c").iterdir() if p.name.startswith("_")]


# ---------------------------------------------------------------- first sights


def test_false_positives_of_a_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, (2, 220_000)).astype(np.uint64)
    bits = seen.Bits(20_000, 0.01)
    bits.add(*keys[:, :20_000])
    assert bits.has(*keys[:, :20_000]).all()
    assert 0.007 < bits.has(*keys[:, 20_000:]).mean() < 0.013
    again = seen.Bits(20_000, 0.01, bits.bits.tobytes())
    assert (again.bits == bits.bits).all()


@pytest.mark.parametrize(("capacity", "error"), [(1 << 16, 1e-6), (64, 0.01)])
def test_first_sights_in_batches(spark, tmp_path, capacity, error):
    """Many more keys than the filters were made for, in three batches; no copy passes, wrong drops stay few."""
    timed.use_state_store(spark)
    day, rng, rows = 86_400, random.Random(5), []
    for number in range(3):  # batches of two days each; a third of all rows has one key
        part = [(0 if rng.random() < 0.33 else rng.randrange(1, 4000), number * 2 * day + rng.randrange(2 * day)) for _ in range(3000)]
        part += [(None, number * 2 * day), (5, None), (5, None)]
        rows += part
        spark.createDataFrame(part, "k long, s long").select("k", F.timestamp_seconds("s").alias("ts"), F.lit("more").alias("_us_")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    files = sorted((tmp_path / "in").glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns)
    assert len(files) == 3
    stream = spark.readStream.schema("k long, ts timestamp, _us_ string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    out = seen.first_seen(stream, "k", generation_seconds=day, capacity=capacity, error=error, late="10 days", buckets=4)
    with runs.Progress(spark) as progress:
        streams.run_available(out, f"{tmp_path}/cp", path=f"{tmp_path}/out")
    got = [(r["k"], r["s"]) for r in spark.read.parquet(f"{tmp_path}/out").select("k", F.unix_seconds("ts").alias("s")).collect()]
    assert sum(k is None for k, _ in got) == 3 and sum(s is None for _, s in got) == 6
    days = {}
    for k, s in rows:
        if k is not None and s is not None:
            days.setdefault((k, s // day), s)
            days[k, s // day] = min(s, days[k, s // day])
    want = {(k, s) for (k, d), s in days.items() if (k, d - 1) not in days}
    whole = [(k, s) for k, s in got if k is not None and s is not None]
    assert len(set(whole)) == len(whole) and set(whole) <= want
    assert len(want) - len(whole) <= 3 * error * len(days) * 2 + (3 if error > 1e-3 else 0)
    batches = progress.frame().collect()
    assert sum(b["rows"] for b in batches) >= len(rows) and max(b["state_rows"] for b in batches) > 0


def test_old_generations_leave_the_state(spark, tmp_path):
    timed.use_state_store(spark)
    day = 86_400
    for number in range(6):
        spark.createDataFrame([(k, number * day + 50_000 + k) for k in range(20)], "k long, s long").select("k", F.timestamp_seconds("s").alias("ts")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("k long, ts timestamp").parquet(f"{tmp_path}/in")
        streams.run_available(seen.first_seen(stream, "k", generation_seconds=day, capacity=64, late="0 seconds", buckets=1), f"{tmp_path}/cp", path=f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 20  # seen each day, so never new again
    held = spark.read.format("statestore").option("path", f"{tmp_path}/cp").option("stateVarName", "filters").load()
    assert {r[0] for r in held.select("user_map_key.generation").collect()} <= {3, 4, 5}


# ---------------------------------------------------------------- runs


def test_a_bad_source_fails_alone(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "good.txt").write_text("one\n")
    (tmp_path / "bad" / "torn.txt.gz").write_bytes(b"\x1f\x8b\x08 not gzip at all")
    (tmp_path / "good").mkdir()
    (tmp_path / "good" / "a.txt").write_text("one\n\ntwo\n")
    (tmp_path / "void").mkdir()
    sources = {n: lambda n=n: spark.read.schema("value string").text(f"{tmp_path}/{n}") for n in ("bad", "good", "void", "gone")}
    frames, report = runs.ingest(spark, sources, f"{tmp_path}/out", {"blank": ("value", F.col("value") == ""), "old": ("age", F.col("age") > 3)})
    told = {r["source"]: r for r in report.collect()}
    assert {k: r["status"] for k, r in told.items()} == {"bad": "failed", "good": "done", "void": "empty", "gone": "missing"}
    assert told["good"]["rows"] == 3 and told["good"]["figures"] == {"blank": 1}
    assert told["bad"]["error"] and "torn.txt.gz" in (told["bad"]["file"] or "")
    assert set(frames) == {"good", "void"} and frames["good"].count() == 3 and frames["void"].count() == 0
