import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from loamstack.operators import auth, costs, datasets, dedup, evaluation, extensions, federated, formatting, graph, health, interactions, quality, sampling, telemetry, topics, web
from loamstack.sources import readers


def at(*minutes):
    return [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m) for m in minutes]


def test_telemetry_files_become_interactions(spark, tmp_path):
    lines = [
        {"event_id": "1", "event_type": "ROUTE_MATCHED", "timestamp": "2024-01-01T00:00:00Z", "properties": {"query": {"text": "hi"}, "response": "yo"}, "metrics": {"confidence": 90}, "tags": ["t"]},
        {"event_id": "2", "event_type": "ROUTE_FAILED", "timestamp": "2024-01-01T00:00:00Z", "properties": {}, "metrics": {}},
        {"event_id": "3", "event_type": "ERROR_OCCURRED", "timestamp": "not a time", "properties": {}, "metrics": {}},
        {"event_id": "4", "event_type": "CONTEXT_ACCESSED", "timestamp": "2024-01-01T00:00:00Z", "properties": {"text": "x"}},
        {"event_id": "5", "event_type": "ROUTE_MATCHED", "timestamp": "2023-01-01T00:00:00Z", "properties": {"text": "old"}},
    ]
    (tmp_path / "a.jsonl").write_text("\n".join([json.dumps(x) for x in lines] + ["", "{broken"]))
    rows = {r["source_id"]: r for r in interactions.from_telemetry(readers.telemetry(spark, str(tmp_path), since="2023-06-01")).collect()}
    assert set(rows) == {"1", "3"}
    assert rows["1"]["user_input"] == "hi" and rows["1"]["confidence"] == pytest.approx(0.9) and rows["1"]["tags"] == ["t", "event:ROUTE_MATCHED"]
    assert rows["1"]["quality_score"] == 1.0
    assert readers.bad_lines(spark, str(tmp_path)).count() == 1


def test_feedback_wrappers_and_corrections(spark, tmp_path):
    items = [
        {"id": "a", "response": "NEGATIVE_FEEDBACK", "pattern": "CODE_DIAGNOSTIC", "notification_text": "bad", "time_to_respond": 1, "context": {"query": "q", "correction": "good"}},
        {"id": "b", "response": "DEFERRED", "context": {}}, 7,
    ]
    (tmp_path / "f.json").write_text(json.dumps({"feedback": items}))
    rows = interactions.from_feedback(readers.feedback(spark, str(tmp_path))).collect()
    assert [r["source_id"] for r in rows] == ["a"]
    assert rows[0]["correction_improved"] == "good" and rows[0]["tags"] == ["code", "diagnostic", "response:NEGATIVE_FEEDBACK"] and rows[0]["confidence"] == 1.0


def test_a_failing_source_is_reported(spark, tmp_path):
    s = readers.Sources()
    assert s.read_all(spark, [("telemetry", str(tmp_path / "none")), ("raw_log", "x")]) is None
    assert len(s.failures) == 2


def test_truncation_keeps_system_and_last_pair_and_takes_newest_first(spark):
    m = [("system", "s" * 8), ("user", "a" * 40), ("assistant", "b" * 4), ("user", "c" * 8), ("assistant", "d" * 8)]
    df = spark.createDataFrame([(m,)], "m array<struct<role:string,content:string>>")
    got = df.select(formatting.truncated_messages(F.col("m"), 8).alias("x")).first()["x"]
    assert [x["content"][0] for x in got] == ["s", "b", "c", "d"]


def test_pairs_of_equal_inputs(spark):
    rows = [(str(k), "q", f"out{k}", o, 0.5, 0.5, False, "telemetry") for k, o in enumerate(["failure", "success", "engaged"])]
    df = spark.createDataFrame(rows, "id string, user_input string, assistant_output string, outcome string, confidence double, quality_score double, is_correction boolean, source_type string")
    got = formatting.preferences_from_pairs(df, "id").collect()
    assert [(r["chosen"], r["rejected"]) for r in got] == [("out1", "out0")]


def test_reasons_come_in_order(spark):
    base = {"messages": None, "instruction": "i", "input_text": "", "prompt": None, "chosen": None, "rejected": None, "is_correction": False}
    rows = [dict(base, id=1, output_text="", estimated_tokens=5, quality_score=0.9), dict(base, id=2, output_text="x", estimated_tokens=9, quality_score=0.9), dict(base, id=3, output_text="x", estimated_tokens=4097, quality_score=0.9),
            dict(base, id=4, output_text="x", estimated_tokens=10, quality_score=0.1), dict(base, id=5, output_text="x", estimated_tokens=10, quality_score=0.9), dict(base, id=6, output_text="x", estimated_tokens=4096, quality_score=0.9)]
    schema = "id int, messages array<struct<role:string,content:string>>, instruction string, input_text string, output_text string, prompt string, chosen string, rejected string, estimated_tokens long, quality_score double, is_correction boolean"
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)
    got = {r["id"]: r["reject_reason"] for r in quality.judged(df, "id").collect()}
    assert got == {1: "no_content", 2: "too_short", 3: "too_long", 4: "below_quality", 5: None, 6: "duplicate"}


def test_greedy_dedup_is_not_components(spark):
    ids = spark.createDataFrame([(k,) for k in range(5)], "vec_id long")
    pairs = spark.createDataFrame([(0, 1), (1, 2), (3, 4)], "a long, b long")
    assert {r["vec_id"] for r in dedup.greedy_kept(ids, pairs).where("kept").collect()} == {0, 2, 3}


def test_split_is_exact_and_stable(spark):
    rows = datasets.split(spark.range(101), "id").collect()
    assert sum(r["split"] == "train" for r in rows) == 90
    assert {r["id"]: r["split"] for r in rows} == {r["id"]: r["split"] for r in datasets.split(spark.range(101).repartition(7), "id").collect()}


def test_sinks_and_versions(spark, tmp_path):
    rows = datasets.split(spark.range(20), "id")
    assert datasets.save_jsonl(rows, str(tmp_path), "d", seed=42)["splits"] == {"train": 18, "validation": 2}
    datasets.save_parquet(rows, str(tmp_path), "p")
    assert spark.read.parquet(f"{tmp_path}/p").count() == 20
    h = spark.createDataFrame([], "version int, digest string, config string")
    h = datasets.rolled_back(datasets.new_version(datasets.new_version(h, "a"), "b"), 1)
    assert tuple(datasets.current_version(h).first()) == (3, "a")
    cur, new = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, t int"), spark.createDataFrame([(2, "c", 2), (3, "d", 2)], "k int, v string, t int")
    assert sorted((r["k"], r["v"]) for r in datasets.upsert(cur, new, ["k"], "t").collect()) == [(1, "a"), (2, "c"), (3, "d")]


def test_anomaly_needs_twenty_samples_and_a_deviation(spark):
    def run(values):
        df = spark.createDataFrame([("m", k, float(v)) for k, v in enumerate(values)], "name string, k int, value double")
        return [(r["k"], r["severity"]) for r in telemetry.anomalies(df, ("name",), ("k",)).collect()]

    assert run([1, 2] * 9 + [1000]) == [] and run([5] * 30) == []
    assert run([1, 2] * 12 + [1000]) == [(24, "critical")]


def test_incidents_close_on_direct_recovery_only(spark):
    rows = [("x", t, s, 1.0) for t, s in zip(at(0, 1, 2, 3, 4, 5, 6), ["healthy", "unhealthy", "healthy", "unhealthy", "degraded", "healthy", "healthy"])]
    df = spark.createDataFrame(rows, "component string, ts timestamp, status string, latency_ms double")
    got = [(r["started"].minute, r["resolved"] and r["resolved"].minute) for r in health.incidents(df).orderBy("started").collect()]
    assert got == [(1, 2), (3, None)]
    assert health.uptime(df).first()["uptime_percent"] == pytest.approx(500 / 7)


def test_alert_cooldown_counts_from_the_last_fired(spark):
    rows = [("x", t, s, 1.0) for t, s in zip(at(0, 2, 4, 6), ["unhealthy", "healthy", "unhealthy", "healthy"])]
    df = spark.createDataFrame(rows, "component string, ts timestamp, status string, latency_ms double")
    assert sorted(r["ts"].minute for r in health.alerts(df, 300).collect()) == [0, 6]


def test_prices_fall_back_by_substring(spark):
    u = spark.createDataFrame([("gpt-4o-mini", 1000, 0), ("gpt-4o-mini-x", 1000, 0), ("other", 10, 10)], "model string, input_tokens long, output_tokens long")
    got = {r["model"]: r["cost"] for r in costs.priced(u, costs.price_table(spark)).collect()}
    assert got["gpt-4o-mini"] == pytest.approx(0.00015) and got["gpt-4o-mini-x"] == pytest.approx(0.0025) and got["other"] == pytest.approx(2e-4)


def test_empty_window_is_moderate_risk(spark):
    schema = "request_id string, authenticated boolean, " + ", ".join(f"{f} double" for f in auth.FACTORS) + ", spoofing_detected boolean, visual_threat_detected boolean, liveness_passed boolean, execution_time_ms double, analysis_mode_used string, reasoning_chain array<string>"
    assert auth.metrics(spark.createDataFrame([], schema)).first()["risk"] == "moderate"


def test_regression_is_an_absolute_drop(spark):
    b, c = spark.createDataFrame([("a", 0.9), ("b", 0.9), ("c", 0.5)], "metric string, value double"), spark.createDataFrame([("a", 0.88), ("b", 0.879), ("new", 1.0)], "metric string, value double")
    assert {r["metric"]: r["regression"] for r in evaluation.compare(b, c, 0.0201).collect()} == {"a": False, "b": True, "c": False}


def test_krum_and_median(spark):
    rows = [(1, c, "p", 0, w, 1, 0.1) for c, w in enumerate([1.0, 1.1, 0.9, 1.05, 9.0])]
    u = spark.createDataFrame(rows, "round int, client_id int, param string, idx int, weight double, num_samples int, loss double")
    assert federated.krum(u).first()["client_id"] in (0, 1, 3)
    assert federated.median(u.where("client_id < 4")).first()["weight"] == 1.0


def test_graph(spark):
    e = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "a")], "source string, target string")
    dag = graph.acyclic(e.withColumn("o", F.monotonically_increasing_id()), "o")
    assert dag.count() == 4
    assert {r["node"]: r["depth"] for r in graph.topological(dag).collect()} == {"a": 0, "b": 1, "c": 1, "d": 2}
    assert graph.separated(dag, "a", "d", ["b", "c"]) and not graph.separated(dag, "a", "d", ["b"])
    assert {r["node"] for r in graph.ancestors(e, "a").collect()} == {"b", "c", "d"}


def test_folds(spark):
    row = spark.range(1).select(
        sampling.early_stop(F.array(*map(F.lit, [3.0, 2.0, 2.0, 2.0, 1.0])), 2).alias("stop"), sampling.competence_path(F.array(*map(F.lit, [0.9, 0.9, 0.9, 0.9]))).alias("d"),
        sampling.advantages(F.array(F.struct(F.lit(1.0).alias("reward"), F.lit(0.0).alias("value"), F.lit(False).alias("done")), F.struct(F.lit(1.0).alias("reward"), F.lit(0.0).alias("value"), F.lit(True).alias("done"))), 0.5, 1.0).alias("gae"),
    ).first()
    assert row["stop"] == 3 and row["d"] == pytest.approx(0.4) and row["gae"] == [1.5, 1.0]


def test_url_policy_and_chunks(spark):
    p = spark.createDataFrame([("bad.com", "blocked", [], []), ("ok.org", "trusted", ["/docs"], ["/docs/x"])], "domain string, verdict string, allowed_paths array<string>, blocked_paths array<string>")
    urls = ["https://sub.bad.com/a", "http://ok.org/docs", "https://www.ok.org/docs/a", "https://ok.org/docs/x/1", "https://ok.org/other", "https://who.net/"]
    got = {r["url"]: r["reason"] for r in web.validated(spark.createDataFrame([(u,) for u in urls], "url string"), p).collect()}
    assert [got[u] for u in urls] == ["domain_blocked", "not_https", None, "path_restricted", "path_restricted", "unknown_domain"]
    assert spark.range(1).select(web.chunked(F.lit("aaaa\n\nbb\n\ncccccc"), 6).alias("c")).first()["c"] == ["aaaa\n\nbb", "cccccc"]


@pytest.mark.parametrize("text, want", [("you must be logged in.", []), ("you must be logged in. login required.", ["login"]), ("verify you are human", ["captcha"]), ("18+ only", ["adult"])])
def test_compliance(spark, text, want):
    body = " ".join(["This is a long enough sentence about nothing at all."] * 8) + text
    df = spark.createDataFrame([("u", "<p>", body, 200)], "url string, html string, text string, http_status int")
    assert web.compliance(df).first()["violations"] == want


def test_page_structure():
    title, description, sections, code, links, text, markdown = web.page_structure("https://a.org/x", '<title>T</title><nav>skip</nav><h1>One</h1><p>p<h2>Two</h2><pre class="language-py">a\nb</pre><a href="/y">y</a><a href="#z">z</a><a href="https://b.org">b</a>')
    assert title == "T" and [s[0] for s in sections] == ["One", "One > Two"] and code[0][:2] == ("py", "a\nb") and links == [("y", "https://a.org/y")] and "skip" not in text and markdown.startswith("# One")


def test_topics_and_queue(spark):
    e = spark.createDataFrame([("use docker and react", t, 0.6, "user_question") for t in at(0, 1)], "text string, ts timestamp, confidence double, source string")
    got = topics.discovered(topics.mentions(e), F.lit("2024-01-02").cast("timestamp"), most=50).collect()
    assert {r["name"] for r in got} == {"docker", "react"} and got[0]["confidence"] == pytest.approx(0.65)
    q = spark.createDataFrame([("1", "pending", 0), ("2", "pending", 3)], "topic_id string, status string, retry_count int")
    out = spark.createDataFrame([("1", False), ("2", False)], "topic_id string, ok boolean")
    assert {r["topic_id"]: r["status"] for r in topics.after_attempt(q, out).collect()} == {"1": "pending", "2": "failed"}


def test_row_functions_catch_errors(spark):
    df = spark.createDataFrame([(1,), (0,)], "x int")
    got = {r["x"]: (r["y"], r["y_error"]) for r in extensions.mapped(df, lambda x: str(1 // x), ["x"], "y").collect()}
    assert got[1] == ("1", None) and got[0][0] is None and "ZeroDivision" in got[0][1]
