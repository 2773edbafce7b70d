"""Exports over HTTP and folders, streams whose state ends, sketches, and the vector index against plain ways."""

import json
import math
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamstack.operators import dedup, sketches, telemetry, vectors
from loamstack.plans import binding
from loamstack.sources import exports
from loamstack.streaming import streams, timed

FOLDER = "/root/testdata/sf0.001"
ITEM = "n long, word string, at timestamp"


# ---------------------------------------------------------------- exports


class Server:
    """An export over HTTP: short pages, every third answer asks to come again; keeps what is posted to it."""

    def __init__(self, items):
        self.items, self.asked, self.posted, self.lock = items, [], [], threading.Lock()
        outer = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                with outer.lock:
                    outer.asked.append(self.path)
                    again = len(outer.asked) % 3 == 0
                q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
                if q.get("key") != "k" or self.headers.get("Authorization") != "t":
                    self.send_error(403)
                elif again:
                    self.send_response(503)
                    self.send_header("Retry-After", "0")
                    self.end_headers()
                else:
                    start = int(q["offset"])
                    body = json.dumps({"rows": outer.items[start : start + min(int(q["limit"]), 7)], "all": len(outer.items)}).encode()
                    self.send_response(200)
                    self.end_headers()
                    self.wfile.write(body)

            def do_POST(self):
                with outer.lock:
                    outer.posted.append((self.headers.get("Idempotency-Key"), json.loads(self.rfile.read(int(self.headers["Content-Length"])))))
                self.send_response(200)
                self.end_headers()

            def log_message(self, *args):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_address[1]}/api?key=k"


@pytest.fixture
def server():
    s = Server([{"n": i, "word": f"wé {i}", "at": f"2024-01-01T00:00:{i % 60:02d}.000123Z"} for i in range(95)])
    yield s
    s.server.shutdown()


OPTIONS = {"items": "rows", "total": "all", "header.Authorization": "t", "page_items": "10", "task_items": "30"}


def test_pages_are_read_in_parts_over_http(spark, server):
    rows = exports.read_export(spark, server.url, ITEM, **OPTIONS)
    assert rows.rdd.getNumPartitions() == 4
    got = rows.orderBy("place").collect()
    assert [(r["place"], r["n"], r["word"], r["at"].microsecond) for r in got] == [(i, i, f"wé {i}", 123) for i in range(95)]
    server.items = []
    assert exports.read_export(spark, server.url, ITEM, **OPTIONS).count() == 0


def test_refusals_are_not_asked_again(spark, server):
    with pytest.raises(Exception, match="403"):
        exports.read_export(spark, server.url, ITEM, **(OPTIONS | {"header.Authorization": "no"})).count()
    assert len(server.asked) < exports.TRIES * 4


def test_a_stream_goes_on_from_its_count(spark, server, tmp_path):
    everything, out = server.items, f"{tmp_path}/out"
    for upto in (40, 40, 95):
        server.items = everything[:upto]
        streams.run_available(exports.stream_export(spark, server.url, ITEM, **OPTIONS), f"{tmp_path}/c", path=out)
        assert sorted(r["n"] for r in spark.read.parquet(out).collect()) == list(range(upto))
    server.items = everything[:50]
    with pytest.raises(Exception, match="95 were read before"):
        streams.run_available(exports.stream_export(spark, server.url, ITEM, **OPTIONS), f"{tmp_path}/c", path=out)


def test_a_source_that_fails_within_a_batch_loses_and_repeats_nothing(spark, server, tmp_path, monkeypatch):
    out, all_items = f"{tmp_path}/out", server.items
    stream = exports.stream_export(spark, server.url, ITEM, **OPTIONS)
    server.items = all_items[:40]
    streams.run_available(stream, f"{tmp_path}/c", path=out)
    failing = exports.stream_export(spark, server.url, ITEM, **OPTIONS).select("place", F.expr("CASE WHEN n = 70 THEN raise_error('broken') ELSE n END").cast("long").alias("n"), "word", "at")
    server.items = all_items
    with pytest.raises(Exception, match="broken"):
        streams.run_available(failing, f"{tmp_path}/c", path=out)
    streams.run_available(stream, f"{tmp_path}/c", path=out)
    assert sorted(r["n"] for r in spark.read.parquet(out).collect()) == list(range(95))


def test_folders_are_written_in_order_appended_and_overwritten(spark, tmp_path):
    url = f"file://{tmp_path}/export"
    rows = spark.range(1000).select((F.lit(999) - F.col("id")).alias("n"), F.when(F.col("id") % 3 > 0, F.lit('a "line"\n')).alias("word"), F.timestamp_micros(F.col("id") * 1_000_001).alias("at"))
    exports.write_export(rows, url, ["n"], page_items="64")
    exports.write_export(rows.limit(0), url, ["n"])
    exports.write_export(rows.where("n < 10"), url, ["n"])
    got = exports.read_export(spark, url, ITEM, task_items="100").orderBy("place").collect()
    assert [r["n"] for r in got] == [*range(1000), *range(10)] and got[3]["at"] == rows.where("n = 3").first()["at"]
    assert {r["word"] for r in got} == {None, 'a "line"\n'}
    exports.write_export(rows.where("n = 5"), url, ["n"], overwrite=True)
    assert [r["n"] for r in exports.read_export(spark, url, ITEM).collect()] == [5]


def test_pages_without_a_commit_are_not_read(spark, tmp_path):
    url = f"file://{tmp_path}/export"
    with pytest.raises(Exception, match="broken"):
        exports.write_export(spark.range(100).select(F.expr("CASE WHEN id = 99 THEN raise_error('broken') ELSE id END").cast("long").alias("n")), url)
    assert exports.FolderPages(url).total() == 0
    exports.write_export(spark.range(10).select(F.col("id").alias("n")), url)
    assert exports.read_export(spark, url, ITEM).count() == 10


def test_push_commits_once_filters_topics_and_tells(spark, server, tmp_path):
    spark.range(30).select(F.col("id").alias("n"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("all")), (F.col("id") % 3 + 1).cast("int")).alias("topic")).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("n long, topic string").parquet(f"{tmp_path}/in")
    url = f"file://{tmp_path}/pushed"
    exports.push(stream, url, f"{tmp_path}/c", ["a"], notify=server.url)
    exports.push(stream, url, f"{tmp_path}/c", ["a"], notify=server.url)
    assert sorted(r["n"] for r in exports.read_export(spark, url, "n long").collect()) == [n for n in range(30) if n % 3 != 1]
    assert server.posted == [("0", {"batch": 0, "upto": 20})]
    # A batch that is committed again changes nothing.
    writer = exports._StreamWriter({"path": url})
    writer.commit([exports.Put(0, [exports.FolderPages(url).put_page(["{}"])])], 0)
    assert exports.FolderPages(url).total() == 20


# ---------------------------------------------------------------- timed streams


@pytest.fixture
def timed_source(spark, tmp_path):
    """Events that come in five batches, each out of order by up to the allowed lateness."""
    timed.use_state_store(spark)
    e = spark.read.parquet(f"{FOLDER}/events.parquet").orderBy("ts", "event_id")
    rows = e.collect()
    parts, cuts = [], [len(rows) * k // 5 for k in range(6)]
    for a, b in zip(cuts, cuts[1:]):
        parts.append(rows[a:b])
    for k in range(4):  # the last event of a batch comes with the next
        parts[k + 1].insert(len(parts[k + 1]) // 2, parts[k].pop())
    path = f"{tmp_path}/in"

    def arrive(k):
        spark.createDataFrame(parts[k], e.schema).coalesce(1).write.mode("append").parquet(path)
        return path

    return arrive, str(tmp_path), rows


LATE = "6 hours"


def test_chains_equal_the_batch_and_state_goes(spark, timed_source):
    arrive, base, rows = timed_source
    held = []
    for k in range(5):
        path = arrive(k)
        streams.run_available(timed.chains(streams.events(spark, path), "user_id", 3600, LATE, buckets=4), f"{base}/c", path=f"{base}/out")
        held.append(timed.live_chains(spark, f"{base}/c", "user_id").count())
    both = spark.read.parquet(f"{base}/out").unionByName(timed.live_chains(spark, f"{base}/c", "user_id"))
    got = sorted((r["user_id"], r["started"], r["ended"], r["events"]) for r in both.collect())
    want = telemetry.sessions(binding.events(spark, FOLDER), "user_id")
    assert got == sorted((str(r["user_id"]), r["started"], r["ended"], r["events"]) for r in want.collect())
    assert max(held) < len(got) / 2 and {r["reason"] for r in both.select("reason").distinct().collect()} == {"ended", "live"}


def test_live_chains_are_bounded_by_giving_up_the_oldest(spark, timed_source):
    arrive, base, rows = timed_source
    for k in range(5):
        path = arrive(k)
        streams.run_available(timed.chains(streams.events(spark, path), "user_id", 10**9, LATE, most=8, buckets=2), f"{base}/c", path=f"{base}/out")
        assert timed.live_chains(spark, f"{base}/c", "user_id").count() <= 8
    out = spark.read.parquet(f"{base}/out")
    assert out.where("reason = 'evicted'").count() == out.count() > 0
    live = timed.live_chains(spark, f"{base}/c", "user_id")
    assert out.unionByName(live).agg(F.sum("events")).first()[0] == len(rows)
    last = {}
    for r in rows:
        last[str(r["user_id"])] = r["ts"]
    newest = max(last.values())
    assert newest in {r["ended"].replace(tzinfo=None) for r in live.collect()}


@pytest.mark.parametrize("kind", ["anomalies", "threats"])
def test_alerts_do_not_depend_on_batches(spark, timed_source, kind):
    arrive, base, rows = timed_source
    make = {
        "anomalies": lambda s: timed.anomalies(s, "event_type", late=LATE, limit=2.0, idle_seconds=10**7),
        "threats": lambda s: timed.threats(s, "user_id", 86400, 2, LATE),
    }[kind]
    for k in range(5):
        path = arrive(k)
        streams.run_available(make(streams.events(spark, path)), f"{base}/c", path=f"{base}/out")
    far = spark.createDataFrame([(10**6, rows[-1]["ts"].replace(year=2030), 10**6, "far", 0.0, "")], streams.EVENTS)
    far.write.mode("append").parquet(path)
    streams.run_available(make(streams.events(spark, path)), f"{base}/c", path=f"{base}/out")
    got = {r["event_id"] for r in spark.read.parquet(f"{base}/out").collect()}
    events = binding.events(spark, FOLDER)
    if kind == "anomalies":
        want = telemetry.anomalies(binding.metrics(spark, FOLDER), ("name",), ("ts", "event_id"), limit=2.0)
    else:
        want = timed.threats_of(events, "user_id", 86400, 2)
    assert got == {r["event_id"] for r in want.collect()} and got


def test_a_silent_key_is_forgotten(spark, tmp_path):
    timed.use_state_store(spark)
    path, base = f"{tmp_path}/in", str(tmp_path)
    make = lambda: timed.anomalies(streams.events(spark, path), "event_type", late="1 minute", idle_seconds=3600)

    def arrive(rows):
        spark.sql("SELECT " + " UNION ALL SELECT ".join(f"{i}L event_id, TIMESTAMP_NTZ'{ts}' ts, 1L user_id, '{k}' event_type, {v}D value, '' props" for i, ts, k, v in rows)).coalesce(1).write.mode("append").parquet(path)
        streams.run_available(make(), f"{base}/c", path=f"{base}/out")

    def keys():
        return {r[0] for r in spark.read.format("statestore").option("path", f"{base}/c").option("stateVarName", "held").load().select("key.event_type").distinct().collect()}

    arrive([(i, f"2024-01-01 00:{i:02d}:00", "a", i) for i in range(30)])
    arrive([(99, "2024-01-01 01:00:00", "b", 1)])
    assert keys() == {"a"}
    arrive([(100, "2024-01-01 09:00:00", "b", 1)])
    assert keys() == {"b"}


# ---------------------------------------------------------------- sketches


@pytest.mark.parametrize("scale", [1, 20])
def test_merged_percentiles_keep_their_rank(spark, scale):
    """Skewed values, ties, one window with very few values and one with none, at two sizes."""
    rows = spark.range(20_000 * scale).select(
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 86_400).alias("ts"), F.when(F.col("id") % 3 == 0, "ties").otherwise("skewed").alias("name"),
        F.when(F.col("id") % 3 == 0, F.floor(F.col("id") % 7).cast("double")).otherwise(F.exp(F.pmod(F.xxhash64("id"), F.lit(10**6)) / 1e5)).alias("value"), (F.col("id") % 5000).alias("user_id"),
    )
    few = spark.sql("SELECT TIMESTAMP'2024-01-02 05:00:00' ts, 'few' name, cast(v AS double) value, 1L user_id FROM VALUES (1), (2), (null) t(v) UNION ALL SELECT TIMESTAMP'2024-01-02 05:00:00', 'none', null, null")
    m = rows.unionByName(few)
    days = sketches.answered(sketches.merged(sketches.merged(sketches.sketched(m, 60, distinct="user_id"), 3600), 86_400))
    errors = {r["name"]: r for r in sketches.rank_errors(days, m, 86_400).collect()}
    assert all(errors[k][p] <= sketches.RANK_ERROR for k in ("ties", "skewed", "few") for p in sketches.PERCENTILES)
    got = {r["name"]: r for r in days.collect()}
    assert got["none"]["n"] == 0 and got["none"]["p50"] is None and got["few"]["distinct"] == 1
    want = {r["name"]: r["d"] for r in m.groupBy("name").agg(F.countDistinct("user_id").alias("d")).collect()}
    assert all(abs(got[k]["distinct"] - want[k]) <= 4 * sketches.DISTINCT_ERROR * want[k] for k in ("ties", "skewed"))


# ---------------------------------------------------------------- similar vectors


def planted(spark, n, seed=1, width=32):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, width))
    out = [(i, v) for i, v in enumerate(base)]
    for k in range(n // 10):
        u = rng.standard_normal(width)
        v = base[k] / np.linalg.norm(base[k])
        u -= (u @ v) * v
        c = rng.uniform(0.951, 0.99)
        out.append((n + k, c * v + math.sqrt(1 - c * c) * u / np.linalg.norm(u)))
    out += [(2 * n + k, base[0] * (1 + k / 100)) for k in range(40)]
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in out], "vec_id long, embedding array<double>"), len(out)


def test_the_index_finds_nine_tenths_and_nothing_else(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    table, n = planted(spark, 2000)
    odd = spark.createDataFrame([(-1, None), (-2, [0.0] * 32), (-3, [float("nan")] * 32), (-4, [1.0, 2.0]), (-5, [2.0, 4.0]), (None, [1.0, 2.0])], "vec_id long, embedding array<double>")
    found = {(r["a"], r["b"]): r["cosine"] for r in vectors.similar_pairs(table.unionByName(odd), 0.95).collect()}
    exact = {(r["a"], r["b"]): r["cosine"] for r in dedup.similar_pairs(table, 0.95).collect()} | {(-5, -4): 1.0}
    assert set(found) <= set(exact) and len(found) >= 0.9 * len(exact)
    assert all(abs(found[p] - exact[p]) < 1e-9 for p in found)
    assert vectors.similar_pairs(table.limit(0), 0.95).count() == 0


def test_work_grows_slower_than_pairs(spark):
    shares = {}
    for n in (1000, 10_000):
        table, rows = planted(spark, n)
        bits, tables = vectors.plan(rows, 0.95)
        posts = vectors.posted(vectors.units(table, "vec_id", "embedding"), bits, tables)
        sizes = [r["count"] for r in posts.groupBy(*vectors.BUCKETS).count().collect()]
        shares[n] = vectors.compared(rows, sizes)
    assert shares[10_000] < 0.4 * shares[1000] and shares[10_000] < 0.1


def test_plans_hold_the_wanted_recall():
    for n in (10, 10**4, 10**9):
        for cosine in (0.4, 0.8, 0.95, 1.0):
            bits, tables = vectors.plan(n, cosine, 0.9)
            agree = (1 - math.acos(cosine) / math.pi) ** bits
            assert 1 - (1 - agree) ** tables >= 0.9 - 1e-9 and tables <= vectors.MOST_TABLES


def test_sketches_pass_over_no_pair(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    monkeypatch.setattr(vectors, "PRODUCTS", 64)
    monkeypatch.setattr(vectors, "PAIRS", 12)
    rng = np.random.default_rng(5)
    rows = []
    for k in range(150):
        x, u = rng.standard_normal((2, 24)) * rng.choice([1, 1, 1, 30], (2, 24))  # a few components stand out
        x /= np.linalg.norm(x)
        u -= (u @ x) * x
        c = (0.9001, 0.8999, 0.95)[k % 3]
        rows += [(2 * k, x), (2 * k + 1, 7 * (c * x + math.sqrt(1 - c * c) * u / np.linalg.norm(u)))]
    rows += [(1000 + k, rows[0][1]) for k in range(40)] + [(1000, rows[0][1])]  # copies, one with a repeated id
    table = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in rows], "vec_id long, embedding array<double>")
    unit = np.array([v / np.linalg.norm(v) for _, v in rows])
    near = unit @ unit.T >= 0.9
    want = sorted((min(rows[i][0], rows[j][0]), max(rows[i][0], rows[j][0])) for i, j in zip(*np.nonzero(np.triu(near, 1))) if rows[i][0] != rows[j][0])
    got = vectors.similar_pairs(table, 0.9, bits_tables=(3, 60)).collect()  # a pair that agrees in no table: below 1 in 10 ** 25
    assert sorted((r["a"], r["b"]) for r in got) == want


def test_what_is_shuffled_grows_with_the_vectors(spark):
    assert len({vectors.plan(n, 0.95, 0.99999) for n in (20_512, 205_128, 1_230_768)}) == 1
    rng = np.random.default_rng(3)
    n, width = 4200, 64
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.standard_normal((n, width)))], "vec_id long, embedding array<double>")
    sc = spark.sparkContext
    stages = lambda: sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    written = lambda: {(s.stageId(), s.attemptId()): s.shuffleWriteBytes() for s in (x.apply(i) for x in [stages()] for i in range(x.size()))}
    seen = written()
    assert vectors.similar_pairs(table, 0.95, recall=0.99999).count() == 0
    _, tables = vectors.plan(n, 0.95, 0.99999)
    assert 0 < sum(b for k, b in written().items() if k not in seen) < n * tables * (8 * width / 2)  # no whole vector for each table
