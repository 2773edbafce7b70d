"""Nulls, empty tables, repeated rows and clashing names: each operator's defined results."""

import pytest
from pyspark.sql import functions as F

from loamstack.llm import decontaminate, html_text, license_scan, media, near_dup, packing, pii, shards, token_store, toxicity


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "plain words to read here today"), (2, None), (3, "..."), (None, "read here today"), (1, "plain words to read here today")], "item_id long, text string")


def test_decontamination(odd_docs, no_docs, bench):
    rows = decontaminate.contamination(odd_docs, bench).collect()
    assert len(rows) == 9 and sum(r["contaminated"] for r in rows) == 4
    assert all(r["items"] == ["", "1"] for r in rows if r["contaminated"])
    assert decontaminate.contamination(no_docs, bench).count() == 0
    assert decontaminate.contamination(odd_docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_near_duplicates(odd_docs, no_docs):
    rows = near_dup.near_duplicates(odd_docs).collect()
    assert len(rows) == 9 and {r["component_id"] for r in rows if r["doc_id"] in (1, 8)} == {1}
    assert [r["kept"] for r in rows if r["doc_id"] is None] == [True]
    assert {(r["doc_id"], r["component_id"]) for r in rows if r["n_shingles"] == 0} == {(2, 2), (3, 3), (7, 7)}
    assert near_dup.near_duplicates(no_docs).count() == 0


def test_personal_data(odd_docs, no_docs):
    assert pii.personal_data(odd_docs).where("size(base) > 0").count() == 0
    assert pii.personal_data(no_docs).count() == 0


def test_toxicity(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([(1, 1), (4, 0)], "doc_id long, toxic int")
    for docs, n in ((odd_docs, 9), (no_docs, 0)):
        rows = toxicity.toxicity(docs, toxicity.fit(docs, labels)).collect()
        assert len(rows) == n and all(0 <= r["score"] <= 1 for r in rows)


def test_media(odd_docs, no_docs):
    rows = media.media_features(media.media_column(odd_docs)).collect()
    assert len(rows) == 9 and {r["payload_bytes"] for r in rows if r["n_bytes"] == 0} == {64}
    assert len({r["media_sha256"] for r in rows if r["doc_id"] in (1, None)}) == 1
    assert media.media_features(media.media_column(no_docs)).count() == 0


def test_shards(odd_docs, no_docs):
    rows = shards.balanced_shards(odd_docs, 3).collect()
    assert len(rows) == 9 and sorted((r["shard"], r["slot"]) for r in rows) == [(s, k) for s in sorted({r["shard"] for r in rows}) for k in range(sum(r["shard"] == s for r in rows))]
    assert shards.balanced_shards(no_docs).count() == 0


def test_tokens(odd_docs, no_docs):
    rows = token_store.read_tokens(token_store.write_tokens(odd_docs)).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 1, 1, 2, 3, 4, 7, 8, 9]
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:k]) for k in range(9)]
    assert token_store.read_tokens(token_store.write_tokens(no_docs)).count() == 0


def test_packing(odd_docs, no_docs):
    rows = packing.pack_documents(odd_docs).collect()
    assert sum(r["piece"] == 0 for r in rows) == 9
    fill = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill.get(r["sequence_id"], 0)
        fill[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(fill.values()) <= 4096
    assert packing.pack_documents(no_docs).count() == 0


def test_licences(odd_docs, no_docs, spark):
    files = odd_docs.select(F.monotonically_increasing_id().alias("key"), F.lit(None).cast("string").alias("path"), "text", "media")
    assert license_scan.scan(files).where("license IS NULL").count() == 9
    assert license_scan.scan(files.limit(0)).count() == 0


def test_licences_of_rows_without_id_and_of_one_id(spark):
    notice = "Licensed under the Apache License, Version 2.0."
    rows = [(None, "a/b/LICENSE", notice), (1, "a/b/x.py", "print()"), (None, "c/d", None), (5, "e/LICENSE", notice), (5, "f/g.py", "plain words")]
    got = sorted((str(r["key"]), r["path"], r["own_license"], r["license"], r["inherited_from"]) for r in license_scan.scan(spark.createDataFrame(rows, "key long, path string, text string")).collect())
    assert got == [
        ("1", "a/b/x.py", None, "Apache-2.0", "a/b"), ("5", "e/LICENSE", "Apache-2.0", "Apache-2.0", None), ("5", "f/g.py", None, None, None),
        ("None", "a/b/LICENSE", "Apache-2.0", "Apache-2.0", None), ("None", "c/d", None, None, None),
    ]


def test_pages(spark):
    rows = [(1, "u", None), (None, None, ""), (3, "u", "<p>a<p>b"), (3, "u", "<p>a<p>b")]
    got = html_text.page_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(7))).collect()
    assert sorted(r["text"] for r in got) == ["", "", "a\n\nb", "a\n\nb"]
