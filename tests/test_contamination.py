"""Contamination by one narrow pass and by joins, against plain sets."""

import random

import numpy as np
import pytest

from loamstack.operators import curation


def plain(text, bench, n):
    grams = lambda t: {tuple(w[i : i + n]) for w in [(t or "").lower().split()] for i in range(len(w) - n + 1)}
    known = set().union(*[grams(b) for b in bench])
    own = grams(text)
    return len(own), len(own & known)


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_both_ways_equal_plain_sets(spark, monkeypatch, most):
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(40)] + ["Ä", "日本", "-"]
    bench = [" ".join(rnd.choices(words, k=rnd.choice([0, 3, 12, 60]))) for _ in range(12)] + [None]
    texts = ["  ".join(rnd.choices(words, k=rnd.choice([0, 1, 4, 30, 300]))) + "\n" + (rnd.choice(bench) or "") for _ in range(80)] + [None, "", " \t\n", "w1 " * 200]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(t,) for t in bench], "text string")
    monkeypatch.setattr(curation, "BITE", 500)
    got = {r["doc_id"]: (r["total"], r["matched"]) for r in curation.ngram_contamination(docs, items, n=4, most_hashes=most).collect()}
    assert got == {k: plain(t, bench, 4) for k, t in enumerate(texts)}
    assert curation.ngram_contamination(docs.limit(0), items, most_hashes=most).count() == 0
    assert curation.ngram_contamination(docs, items.limit(0), n=4, most_hashes=most).where("matched > 0").count() == 0


def test_rows_without_id_and_repeated_ids_are_judged_by_themselves(spark):
    text = " ".join(f"w{k}" for k in range(20))
    docs = spark.createDataFrame([(None, text), (1, text), (1, "other words"), (None, None)], "doc_id long, text string")
    got = curation.ngram_contamination(docs, spark.createDataFrame([(text,)], "text string")).collect()
    assert sorted((str(r["doc_id"]), r["total"], r["matched"], r["contaminated"]) for r in got) == [("1", 0, 0, False), ("1", 8, 8, True), ("None", 0, 0, False), ("None", 8, 8, True)]


def test_runs_do_not_cross_texts():
    text, first, second = curation.gram_hashes(["a b c", "", "c d", "a b c a b c"], 3)
    assert list(np.bincount(text, minlength=4)) == [1, 0, 0, 3] and len(first) == len(second) == 4
