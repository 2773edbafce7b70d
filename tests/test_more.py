"""Sources, sinks, states, retries and streams that no query over the star tables reaches."""

import json

import pytest
from pyspark.sql import functions as F

from loamstack.functions.probing import interpolated
from loamstack.operators import datasets, evaluation, extensions, graph, sampling, telemetry
from loamstack.sources import readers
from loamstack.streaming import streams


@pytest.mark.parametrize("form", ["parquet", "orc", "csv", "json"])
def test_stored_forms_are_read_back(spark, tmp_path, form):
    rows = spark.createDataFrame([(1, "a b"), (2, None)], "k long, t string")
    rows.write.format(form).options(header="true").save(f"{tmp_path}/x")
    assert sorted(map(tuple, readers.stored(spark, f"{tmp_path}/x", form, "k long, t string").collect()), key=str) == [(1, "a b"), (2, None)]


def test_logs_of_both_names_are_read(spark, tmp_path):
    line = lambda k, t: json.dumps({"id": k, "time": t, "type": "x", "query": "q"})
    (tmp_path / "a.log").write_text(line("1", "2024-01-01T00:00:00Z") + "\nnot json\n")
    (tmp_path / "b.jsonl").write_text(line("2", "2024-01-02T00:00:00Z") + "\n")
    (tmp_path / "c.txt").write_text(line("3", "2024-01-03T00:00:00Z") + "\n")
    assert [r["event_id"] for r in readers.latest_log_events(spark, str(tmp_path)).collect()] == ["2", "1"]
    sources = readers.Sources()
    (tmp_path / "x_state.json").write_text("{}")
    sources.read_folder(spark, str(tmp_path))
    assert {k.split(":")[0] for k in sources.failures} >= {"raw_log", "state_file"}


def test_auth_records_come_from_arrays_and_wrappers(spark, tmp_path):
    record = {"id": "r1", "outcome": "SUCCESS", "voice_confidence": 0.7, "reasoning": ["a"]}
    (tmp_path / "one.json").write_text(json.dumps([record]))
    (tmp_path / "two.json").write_text(json.dumps({"auth_history": [record | {"id": "r2"}]}))
    got = readers.auth_records(spark, str(tmp_path)).collect()
    assert {(r["id"], r["outcome"], r["voice_confidence"], tuple(r["reasoning"])) for r in got} == {("r1", "SUCCESS", 0.7, ("a",)), ("r2", "SUCCESS", 0.7, ("a",))}


def test_sinks_write_each_row_and_whole_states(spark, tmp_path):
    datasets.save_each(spark.range(5).coalesce(1), f"{tmp_path}/each")
    assert len(list((tmp_path / "each").glob("*.json"))) == 5
    folder = f"{tmp_path}/state"
    assert datasets.latest_state(spark, folder, "id long").count() == 0
    for version in (1, 2):
        datasets.save_state(spark.range(version), folder, version)
    (tmp_path / "state/version=000000000003").mkdir()
    assert datasets.latest_state(spark, folder, "id long").count() == 2


def test_dead_letters_are_tried_again_and_given_up(spark):
    rows = spark.createDataFrame([(1, "1"), (2, "x")], "k long, t string")
    letters = extensions.dead_letters(extensions.mapped(rows, int, ["t"], "n", "long"), "n")
    assert [r["k"] for r in letters.collect()] == [2]
    once = extensions.retried(letters, int, ["t"], "n", "long", most=2)
    twice = extensions.retried(once.drop("state"), int, ["t"], "n", "long", most=2)
    assert [r["state"] for r in once.collect()] == ["waiting"] and [(r["state"], r["retry_count"]) for r in twice.collect()] == [("given_up", 2)]
    assert [r["state"] for r in extensions.retried(letters, len, ["t"], "n", "long").collect()] == ["done"]


def test_settings_are_filled_and_typed():
    got = interpolated({"a": "${N}", "b": "${M:-2.5}", "c": "x${T}", "d": "${B:-true}", "e": "${NONE}"}, {"N": "7", "T": "y"})
    assert got == {"a": 7, "b": 2.5, "c": "xy", "d": True, "e": ""}


def test_triggers_fire_at_each_multiple_wherever_batches_are_cut(spark, tmp_path):
    for k in range(3):
        spark.range(k * 10, k * 10 + 10).select(F.col("id").alias("event_id"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), F.lit(1).cast("long").alias("user_id"), F.lit("a").alias("event_type"), F.lit(1.0).alias("value"), F.lit("").alias("props")).coalesce(1).write.parquet(f"{tmp_path}/e/{k}")
    for per_batch, name in ((1, "cut"), (3, "whole")):
        out = streams.count_triggers(streams.events(spark, f"{tmp_path}/e/*", files_per_trigger=per_batch), "event_type", 4)
        streams.run_available(out, f"{tmp_path}/c{name}", name, "append")
        assert sorted(r["total"] for r in spark.table(name).collect()) == [4, 8, 12, 16, 20, 24, 28]


def test_published_events_reach_other_receivers(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-02 00:00:00")], "event_id long, t string").select("event_id", F.col("t").cast("timestamp_ntz").alias("ts"), F.lit(1).cast("long").alias("user_id"), F.lit("a").alias("event_type"), F.lit(1.0).alias("value"), F.lit("").alias("props"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/e")
    streams.publish(streams.events(spark, f"{tmp_path}/e"), f"{tmp_path}/out", f"{tmp_path}/c")
    assert len(list((tmp_path / "out").glob("day=*/*.json"))) == 2
    seen = streams.tailed(spark, f"{tmp_path}/out/*", "event_id long", glob="*.json")
    streams.run_available(seen, f"{tmp_path}/c2", "seen", "append")
    assert sorted(r["event_id"] for r in spark.table("seen").collect()) == [1, 2]


def test_noise_depends_on_the_row_alone(spark):
    one = graph.simulated(spark, ["a", "b"], {"b": ["a"]}, 2000)
    rows, again = sorted(map(tuple, one.collect())), sorted(map(tuple, one.repartition(7).collect()))
    assert rows == again
    mean, sd = one.agg(F.avg("a"), F.stddev("a")).first()
    scale = sd
    assert abs(mean) < 0.1 * max(scale, 0.1) + 0.05


def test_policies_and_predicates_by_name(spark):
    rows = spark.createDataFrame([("k", i) for i in range(6)], "k string, i int")
    keep = lambda p: sorted(r["i"] for r in telemetry.admitted(rows, 2, p, ("k",), "i").collect())
    assert (keep("drop_oldest"), keep("drop_newest"), keep("block")) == ([4, 5], [0, 1], [0, 1])
    with pytest.raises(ValueError, match="no policy"):
        keep("other")
    cases = spark.createDataFrame([("yes", "e"), ("no", "e"), ("no", "none")], "reply string, evaluator string")
    assert [r["passed"] for r in evaluation.evaluated(cases, {"e": lambda r: r == "yes"}).collect()] == [True, False, None]


def test_one_row_of_each_cluster_by_nearness_and_score(spark):
    rows = spark.createDataFrame([(k, [float(k % 3) * 10 + k / 100, 0.0], k / 30) for k in range(30)], "id long, v array<double>, s double")
    for score in (None, "s"):
        got = sampling.clustered(rows, 3, "id", "v", score, 0.9).collect()
        assert len(got) == 3 and len({r["id"] % 3 for r in got}) == 3
    assert {r["id"] for r in got} == {27, 28, 29}


def test_graphs_of_any_size_lose_the_edge_that_closes_a_cycle(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "source long, target long")
    assert sorted(graph.acyclic(edges, "source").collect()) == [(1, 2), (2, 3)]


def test_main_content_is_picked_and_boilerplate_left_out():
    from loamstack.operators import web

    page = """<title>T</title><div class="navbar x">nav</div><p>before</p><div id=content>lower</div><main><h1>One</h1><p>text <b>bold</b><div class="ads">buy</div><h2>Two</h2><pre>x = 1</pre></main><p>after <a href="/a">link</a></p><div id=disqus_thread>c</div>"""
    title, _, sections, code, links, text, _ = web.page_structure("https://h.example/x", page)
    assert title == "T" and [s[2] for s in sections] == ["One", "Two"] and code[0][1] == "x = 1"
    assert "text bold" in text and not any(w in text for w in ("before", "after", "lower", "buy", "nav"))
    assert links == [("link", "https://h.example/a")]
    assert web.page_structure("", "<div class='content'>a<div>b</div>c</div>d")[5].split() == ["a", "b", "c"]
    assert web.page_structure("", "<main></main>all of it")[5] == "all of it"
    assert web.page_structure("", None)[5] == ""


def test_parts_of_time_see_the_rows_before_them(spark):
    """Sparse and dense stretches, several keys, parts with fewer rows than the window: as one window over each key."""
    import random

    rng, rows, t = random.Random(3), [], 0
    for k in range(600):
        t += rng.choice([1, 5, 400, 4000])
        rows.append((k, rng.choice("aab"), t, rng.choice([1.0, 2.0, 3.0, 90.0])))
    m = spark.createDataFrame(rows, "event_id long, name string, t long, value double").withColumn("ts", F.timestamp_seconds("t"))
    read = lambda **o: sorted(map(str, telemetry.anomalies(m, ("name",), ("ts", "event_id"), span=30, least=5, limit=1.5, **o).select("event_id", F.round("z", 6), "samples").collect()))
    assert read() == read(split_seconds=3600) == read(split_seconds=50) != []


def test_greedy_choices_equal_plain_loops(spark):
    import random

    rng = random.Random(4)
    rows = [(k, " ".join(rng.choice("a b c d e f g h".split()) for _ in range(rng.randint(1, 6))), rng.randint(0, 20) / 20) for k in range(40)]
    got = [r["id"] for r in sampling.diverse(spark.createDataFrame(rows, "id long, t string, s double"), 10, "id", "t", "s").orderBy("place").collect()]
    words, chosen, left = {k: set(t.split()) for k, t, _ in rows}, [], {k: s for k, _, s in rows}
    while len(chosen) < 10:
        over = lambda k: max((len(words[k] & words[c]) / len(words[k]) for c in chosen), default=0.0)
        value = lambda k: left[k] if not chosen else left[k] * 0.7 + 0.3 * (1 - over(k))
        chosen.append(min(left, key=lambda k: (-round(value(k), 12), -left[k], k)))
        left.pop(chosen[-1])
    assert got == chosen
    points = spark.createDataFrame([(k, [float(k % 7), float(k // 7)]) for k in range(49)], "id long, v array<double>")
    centres = [r["id"] for r in sampling.k_centres(points, 10, "id", "v").orderBy("place").collect()]
    at = lambda k: (k % 7, k // 7)
    assert len(set(centres)) == 10
    for n in range(1, 10):
        gap = lambda k: min((at(k)[0] - at(c)[0]) ** 2 + (at(k)[1] - at(c)[1]) ** 2 for c in centres[:n])
        assert gap(centres[n]) == max(gap(k) for k in range(49) if k not in centres[:n])


@pytest.mark.parametrize(("size", "n", "pool", "budget", "most"), [(300, 40, 8, 1 << 20, 40), (300, 25, 8, 12, 25), (4000, 160, 256, 1 << 20, 20)])
def test_rounds_of_a_greedy_choice(spark, monkeypatch, size, n, pool, budget, most):
    """Equal to the plain loop with small pools, with texts beyond the word budget, ties, nulls and repeated keys; far fewer rounds than rows."""
    import random

    rng, rounds = random.Random(size + n), []
    monkeypatch.setattr(sampling, "POOL", pool)
    monkeypatch.setattr(sampling, "POOL_WORDS", budget)
    compared = sampling._compared
    monkeypatch.setattr(sampling, "_compared", lambda *a: rounds.append(1) or compared(*a))
    rows = [(k, " ".join(f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(rng.choice([1, 5, 30]))), round(rng.random(), rng.choice([1, 6]))) for k in range(size)]
    rows += [rows[3], rows[3], (size, None, 0.9), (size + 1, "", 0.95), (size + 2, "w1", None), (None, "w1 w2", 1.0)]
    got = sampling.diverse(spark.createDataFrame(rows, "id long, t string, s double").repartition(4), n, "id", "t", "s")
    assert got.columns == ["id", "score", "place"]
    left = {k: (s, set((t or "").split())) for k, t, s in rows if k is not None and s is not None}
    over, want = dict.fromkeys(left, 0.0), []
    while len(want) < n:
        value = lambda k: left[k][0] * (1 - 0.3) + 0.3 * (1 - over[k]) if want else left[k][0]
        want.append(min(left, key=lambda k: (-value(k), -left[k][0], k)))
        _, words = left.pop(want[-1])
        over = {k: max(over[k], len(left[k][1] & words) / len(left[k][1]) if left[k][1] else 0.0) for k in left}
    assert [r["id"] for r in got.orderBy("place").collect()] == want
    assert len(rounds) < most
    assert sampling.diverse(spark.createDataFrame([], "id long, t string, s double"), n, "id", "t", "s").count() == 0


def test_polls_and_fallbacks(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"k": 1}, {"k": 2}, {"k": 3}]))
    assert [r["place"] for r in readers.items_after(spark, str(tmp_path / "a.json"), 2).collect()] == [2]
    made = lambda: spark.createDataFrame([(9,)], "k long")
    assert sorted(r["k"] for r in readers.cases_or(spark, str(tmp_path / "a.json"), "k long", made).collect()) == [1, 2, 3]
    assert [r["k"] for r in readers.cases_or(spark, str(tmp_path / "none.json"), "k long", made).collect()] == [9]


def test_a_teachers_replies_are_scored(spark):
    rows = spark.createDataFrame([(1, "good"), (2, "bad")], "k long, t string")
    got = extensions.scored(rows, lambda t: 'I say {"overall_score": 8}' if t == "good" else "no idea", "t").collect()
    assert {(r["k"], r["score"], r["recommendation"]) for r in got} == {(1, 8.0, "keep"), (2, 0.0, "reject")}
