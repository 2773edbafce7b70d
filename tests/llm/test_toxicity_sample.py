"""What the model is fitted on: bounded in rows and bytes, and never a class left out for one long text."""

import random

import pytest
from pyspark.sql import functions as F

from loamstack.llm import toxicity

CLEAN, TOXIC = "river stone meadow lantern harbour copper willow garden window silver".split(), "vile scum wretch".split()


def table(spark, n, long_class=None, bytes_=0, seed=3):
    """Labelled texts of ten words, toxic ones with one of three words; one row of ``long_class`` is that long and comes first in the order of hashes."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        toxic = i % 2
        words = [rnd.choice(CLEAN) for _ in range(10)]
        if toxic:
            words[rnd.randrange(10)] = rnd.choice(TOXIC)
        rows.append((i, " ".join(words), toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    if long_class is not None:
        first = docs.where((F.col("toxic") == long_class) & (toxicity.remainder() != toxicity.HELD_OUT)).orderBy(F.xxhash64("doc_id")).first()["doc_id"]
        filler = F.repeat(F.lit(" ".join(CLEAN) + " "), bytes_ // len(" ".join(CLEAN) + " ") + 1)
        docs = docs.withColumn("text", F.when(F.col("doc_id") == first, F.concat(filler, F.col("text"))).otherwise(F.col("text")))
    return docs.drop("toxic"), docs.select("doc_id", "toxic")


@pytest.mark.parametrize("long_class", [0, 1])
def test_one_long_text_does_not_turn_the_model_off(spark, long_class):
    docs, labels = table(spark, 300, long_class, 9 << 20)
    model = toxicity.fit(docs, labels)
    told = toxicity.toxicity(docs, model).join(labels, "doc_id").where("held_out")
    share = {r["toxic"]: r["p"] for r in told.groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()}
    assert share[1] >= 0.9 and share[0] <= 0.1


def test_a_class_of_one_text_beyond_the_bound_is_fitted(spark):
    docs, labels = table(spark, 60, 1, 9 << 20)
    kept = labels.join(docs.where(F.length("text") > 1000).select("doc_id"), "doc_id").unionByName(labels.where("toxic = 0"))
    known = kept.where(toxicity.remainder() != toxicity.HELD_OUT)
    assert {r["toxic"] for r in toxicity.training_sample(docs, known, 100).collect()} == {0, 1}


def test_the_sample_is_bounded_and_long_texts_come_last(spark, monkeypatch):
    docs, labels = table(spark, 200, 0, 2000)
    known = labels.where(toxicity.remainder() != toxicity.HELD_OUT)
    monkeypatch.setattr(toxicity, "LONG_BYTES", 1000)
    rows = toxicity.training_sample(docs, known, 40).collect()
    assert sorted(r["toxic"] for r in rows) == [0] * 20 + [1] * 20 and max(len(r["text"]) for r in rows) < 1000
    monkeypatch.setattr(toxicity, "TRAIN_BYTES", 1500)
    rows = toxicity.training_sample(docs, known, 40).collect()
    assert {r["toxic"] for r in rows} == {0, 1} and sum(len(r["text"]) for r in rows) <= 1500


def test_labels_without_a_text_take_no_places(spark):
    docs, labels = table(spark, 60)
    more = labels.unionByName(spark.range(1000, 3000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic")))
    known = more.where(toxicity.remainder() != toxicity.HELD_OUT)
    assert toxicity.training_sample(docs, known, 20).count() == 20
