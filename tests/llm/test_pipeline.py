from pyspark.sql import functions as F

import corpus_pipeline
from loamstack.llm import decontaminate, near_dup, pii, store, toxicity

FOLDER = "/root/testdata/sf0.001"


def test_each_stage_equals_its_operator(spark):
    docs = store.table(spark, FOLDER, "documents")
    out, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in out.collect()}
        nxt = store.materialize(stage(spark, out, FOLDER), name)
        after = {r["doc_id"]: r["text"] for r in nxt.collect()}
        assert nxt.columns == columns
        if name == "toxicity":
            scores = toxicity.toxicity(out, toxicity.fit(out, store.table(spark, FOLDER, "labels"))).collect()
            assert set(after) == {r["doc_id"] for r in scores if not r["predicted"]}
        elif name == "near_dedup":
            assert set(after) == {r["doc_id"] for r in near_dup.near_duplicates(out).collect() if r["kept"]}
        elif name == "decontamination":
            judged = decontaminate.contamination(out, store.table(spark, FOLDER, "benchmark")).collect()
            assert set(after) == {r["doc_id"] for r in judged if not r["contaminated"]}
        else:
            assert set(after) == set(before) and not any(pii.base_spans(t) for t in after.values() if t)
        out = nxt
    packed = corpus_pipeline.packing_stage(spark, out, FOLDER)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in out.collect()}


def test_stages_take_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    """Nulls, empty and long texts, repeated rows and ids, rows without id, and columns with the names that stages use."""
    place = odd_docs.withColumn("_loam_row", F.lit("x")).withColumn("_loam_row_", F.lit(1)).withColumn("component_id", F.lit("y"))
    docs = store.materialize(place, "odd")
    ids = sorted((r["doc_id"] for r in docs.collect()), key=str)
    want = {"near_dedup": ["1", "2", "3", "4", "7", "9"], "decontamination": [str(i) for i in ids], "personal_data": [str(i) for i in ids]}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, FOLDER)
        assert got.columns == docs.columns
        rows = got.collect()
        found = sorted((str(r["doc_id"]) for r in rows), key=str)
        assert found == sorted(want[name]) if name in want else {"None", "2", "3", "7"} <= set(found), name
        assert all(r["component_id"] == "y" and r["_loam_row"] == "x" for r in rows)
        assert {(r["doc_id"], r["text"]) for r in rows} <= {(r["doc_id"], r["text"]) for r in docs.collect()}
        empty = store.materialize(no_docs, "none")
        out = stage(spark, empty, FOLDER)
        assert out.columns == empty.columns and out.count() == 0
    pieces = corpus_pipeline.packing_stage(spark, docs, FOLDER)
    assert sorted((str(r["doc_id"]) for r in pieces.where("piece = 0").collect())) == sorted(str(i) for i in ids)
    assert corpus_pipeline.packing_stage(spark, store.materialize(no_docs, "none"), FOLDER).count() == 0


def test_near_copies_leave_the_first_by_id_then_place(spark):
    text = " ".join(f"word{k}" for k in range(60))
    rows = [(None, text), (9, text), (4, text + " more"), (4, text), (5, "alpha beta gamma"), (5, "one two three"), (None, None), (6, "")]
    docs = store.materialize(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), "rows")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup_stage(spark, docs, FOLDER).collect()]
    assert sorted(got, key=str) == sorted([(4, text + " more"), (5, "alpha beta gamma"), (5, "one two three"), (None, None), (6, "")], key=str)
