"""Results that larger tables and odd rows brought up."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamstack.functions import scores as S
from loamstack.operators import curation, sampling, web
from loamstack.streaming import timed

PROSE = "A plain sentence that is long enough to count as one. " * 5


@pytest.mark.parametrize("end, marks", [("aoneshare onealy th", 0), ("oftheshare onstor", 0), ("we share onions", 0), ("Share this on", 1), ("share via mail", 1)])
def test_a_sign_of_sharing_is_made_of_whole_words(spark, end, marks):
    text = PROSE + end
    got = spark.range(1).select(S.page_quality(F.lit(text)).alias("q")).first()["q"]
    assert got == pytest.approx(0.5 + len(text) / 10000 + 5 / 50 - 0.05 * marks)


def test_nearest_multiplies_blocks_and_keeps_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(sampling, "QUERIES", 3)
    x = np.random.default_rng(5).standard_normal((40, 6)).round(2)
    rows = [(i, x[i % 30].tolist()) for i in range(40)] + [(100, None), (101, [0.0] * 6), (102, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (103, [float("nan")] * 6)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = table.where("vec_id % 5 = 0")
    found = sampling.nearest(asked, table, 4)
    assert not any(word in found._jdf.queryExecution().optimizedPlan().toString() for word in ("zip_with", "aggregate(")), "no cosine row by row"
    got = {(r["query"], r["rank"]): (r["vec_id"], r["cosine"]) for r in found.collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in range(0, 40, 5):
        want = sorted((-round(float(u[q % 30] @ u[i % 30]), 9), i) for i in range(40) if i != q)[:4]
        assert [got[q, n + 1][0] for n in range(4)] == [i for _, i in want]
        assert [got[q, n + 1][1] for n in range(4)] == pytest.approx([-c for c, _ in want])
    assert [got[100, n + 1] for n in range(4)] == [(n, None) for n in range(4)]
    few = sampling.nearest(table.where("vec_id = 0"), table.where("vec_id IN (0, 7, 100, 101, 102, 103)"), 4).orderBy("rank").collect()
    assert [r["vec_id"] for r in few] == [7, 100, 101, 102]


def test_pages_are_handed_on_in_bites_and_only_with_the_columns_asked_for(spark, monkeypatch):
    monkeypatch.setattr(web, "BITE", 40)
    pages = [(i, "https://a.example/x", f"<title>t{i}</title><h1>h</h1><p>{'word ' * (i * 7)}</p><a href='/b'>b</a>" if i % 3 else None) for i in range(12)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    whole = {r["page_id"]: r for r in web.structured(table).collect()}
    for i, url, html in pages:
        made = web.page_structure(url, html)
        assert (whole[i]["title"], whole[i]["text"], whole[i]["markdown"]) == (made[0], made[5], made[6])
        assert [tuple(x) for x in whole[i]["sections"]] == made[2] and [tuple(x) for x in whole[i]["links"]] == made[4]
    some = web.structured(table, "title", "sections")
    assert some.columns == ["page_id", "url", "title", "sections"]
    assert {r["page_id"]: (r["title"], r["sections"]) for r in some.collect()} == {i: (r["title"], r["sections"]) for i, r in whole.items()}


def test_preprocessing_reads_documents_once(spark, tmp_path, monkeypatch):
    words = " ".join(f"w{k}" for k in range(40))
    rows = [(1, words), (2, words), (3, "x x x x x"), (4, None), (5, None), (None, words), (6, "other " + words[:90])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    docs, bench = spark.read.parquet(f"{tmp_path}/docs"), spark.createDataFrame([("b", " ".join(f"z{k}" for k in range(20)))], "item_id string, text string")
    made = curation.preprocessed(docs, bench, 0.4)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
    reasons = lambda df: sorted(str((r["doc_id"], r["reject_reason"])) for r in df.collect())
    want = sorted(str(x) for x in [(None, None), (1, "duplicate"), (2, "duplicate"), (3, "low_quality"), (4, None), (5, "duplicate"), (6, None)])
    assert reasons(made) == want
    own = spark.createDataFrame([("b", words)], "item_id string, text string")
    want = sorted(str(x) for x in [(None, None), (1, "contaminated"), (2, "contaminated"), (3, "low_quality"), (4, None), (5, "duplicate"), (6, "contaminated")])
    assert reasons(curation.preprocessed(docs, own, 0.4)) == want
    whole = curation.ngram_contamination
    monkeypatch.setattr(curation, "ngram_contamination", lambda *a, **k: whole(*a, most_hashes=1, **k))
    assert reasons(curation.preprocessed(docs, own, 0.4)) == want, "joined"


def test_perplexity_sends_common_words_and_joins_the_rest(spark):
    import math
    from collections import Counter

    texts = [(1, "a a b c"), (2, "a b d"), (1, "e"), (3, ""), (4, None), (5, "f f A")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    tokens = [(i, w) for i, t in texts for w in (t or "").lower().split()]
    total = Counter(w for _, w in tokens)
    want = {i: math.exp(-sum(math.log(total[w] / len(tokens)) for j, w in tokens if j == i) / sum(j == i for j, _ in tokens)) for i, _ in tokens}
    for most in (1, 3, 100):
        got = {r["doc_id"]: r["perplexity"] for r in curation.unigram_perplexity(docs, "doc_id", "text", most).collect()}
        assert got == pytest.approx(want), most


def test_anomalies_of_many_rows_are_those_of_one_at_a_time():
    import time

    import pandas as pd

    r = np.random.default_rng(3)
    rows = np.array(list(zip(range(300_000), range(300_000), r.exponential(10, 300_000))), [("us", "<i8"), ("event_id", "<i8"), ("value", "<f8")])
    made = timed.Anomalies("k", 1, 100, 20, 3.0)
    began = time.time()
    held, found = made.step([], rows)
    assert time.time() - began < 10, "the rows of a batch are judged together"
    s = pd.Series(rows["value"]).rolling(100, min_periods=20)
    z = (rows["value"] - s.mean()) / s.std()
    assert [f[1] for f in found] == np.flatnonzero(z.abs() > 3).tolist() and [f[3] for f in found] == pytest.approx(z[z.abs() > 3].tolist())
    cut, parts = [], []
    for a, b in ((0, 10), (10, 15), (15, 119), (119, 5000)):
        cut, some = made.step(cut, rows[a:b])
        parts += some
    assert [f[1] for f in parts] == [f[1] for f in found if f[1] < 5000] and len(cut) == 100 == len(held)


def test_chains_ask_the_state_once_for_a_key():
    import pandas as pd

    class State(dict):
        asked = 0

        def exists(self):
            return bool(self)

        def updateValue(self, k, v):
            self.asked += 1
            self[k] = v

        def iterator(self):
            return iter(self.items())

    class Due:
        def exists(self):
            return False

        def update(self, at):
            self.at = at

    made = timed.Chains("k", 10, 5)
    made.chains, made.due = State(), Due()
    made.handle = type("Handle", (), {"registerTimer": staticmethod(lambda at: None)})()
    batch = lambda *rows: pd.DataFrame({"k": [k for k, _ in rows], "ts": pd.to_datetime([u for _, u in rows], unit="us")})
    assert not list(made.handleInputRows((0,), iter([batch(("a", 3), ("b", 50), ("a", 30)), batch(("a", 12), ("b", 60), ("a", 1))]), None))
    assert dict(made.chains) == {("a",): ([1, 30], [12, 30], [3, 1]), ("b",): ([50, 60], [50, 60], [1, 1])} and made.chains.asked == 2
