import pytest

from loamstack.operators import telemetry
from loamstack.plans import binding
from loamstack.streaming import streams

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def source(spark, tmp_path):
    spark.read.parquet(f"{FOLDER}/events.parquet").repartitionByRange(3, "ts").sortWithinPartitions("ts").write.parquet(f"{tmp_path}/in")
    return f"{tmp_path}/in", str(tmp_path)


def test_windows_equal_the_batch(spark, source):
    path, base = source
    streams.run_available(streams.windowed(streams.events(spark, path), 3600), f"{base}/c", "hours", "complete")
    got = {(r["window_start"], r["event_type"]): r["n"] for r in spark.table("hours").collect()}
    want = telemetry.windowed(binding.metrics(spark, FOLDER), 3600)
    assert got == {(r["window_start"], r["name"]): r["n"] for r in want.collect()}


def test_duplicates_are_dropped_once(spark, source):
    path, base = source
    twice = streams.events(spark, path)
    twice = twice.union(twice)
    streams.run_available(streams.deduplicated(twice, "event_id"), f"{base}/c", path=f"{base}/out")
    out = spark.read.parquet(f"{base}/out")
    assert out.count() == out.select("event_id").distinct().count() == spark.read.parquet(path).count()


def test_anomalies_equal_the_batch(spark, source):
    path, base = source
    streams.run_available(streams.anomalies(streams.events(spark, path), "event_type"), f"{base}/c", path=f"{base}/out")
    got = {r["event_id"] for r in spark.read.parquet(f"{base}/out").collect()}
    want = {r["event_id"] for r in telemetry.anomalies(binding.metrics(spark, FOLDER), ("name",), ("ts", "event_id")).collect()}
    assert got == want


def test_fan_out(spark, source):
    path, base = source
    seen = {}
    handlers = {k: lambda df, n, k=k: seen.update({k: seen.get(k, 0) + df.count()}) for k in ("click", "error")}
    streams.fan_out(streams.events(spark, path), f"{base}/c", handlers)
    counts = {r["event_type"]: r["count"] for r in spark.read.parquet(path).groupBy("event_type").count().collect()}
    assert seen == {k: counts[k] for k in ("click", "error")}
