"""The training-corpus pipeline: documents in, packed sequences out.

Each stage takes the documents that its predecessor kept and returns their columns; the
last returns the packed pieces.  Rows are told apart by their place in the stage's
Parquet input, so rows without id and repeated rows are judged like any other.

Defined results, for each stage: an empty table gives an empty one with the same columns;
other columns are carried on unread, whatever their names; a null or empty text has
nothing toxic beyond what the model gives an empty window, no near-duplicate, no benchmark
passage and no personal data, so it stays and is packed as its end id alone; rows that repeat
others whole are near-duplicates of them, of which the first by id, then by place, stays
(the least id is that of a row with an id, where there is one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstack.llm import bloom, decontaminate, near_dup, packing, pii, store, toxicity


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labelled ones, does not reject."""
    model = toxicity.fit(docs, store.table(spark, sf_dir, "labels"))
    score = toxicity.score_udf(docs.sparkSession, model)
    return docs.where(score(F.col("text")) < toxicity.THRESHOLD)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that with the smallest id; rows without id come last, equal ids by place."""
    row = store.unused(docs, "_loam_row")
    rows = docs.withColumn(row, F.monotonically_increasing_id())
    judged = near_dup.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text")).select(F.col("doc_id").alias(row), "component_id")
    placed = store.materialize(judged.join(rows.select(row, "doc_id"), row), "placed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", row))
    groups = placed.groupBy("component_id").agg(F.count("*").alias("rows"), first.alias("first")).where("rows > 1").select("component_id", F.col(f"first.{row}").alias("stays"))
    gone = store.materialize(placed.join(groups, "component_id").where(F.col(row) != F.col("stays")).select(row), "gone")
    return without(rows, row, gone).drop(row)


def without(rows: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """``rows`` but those whose key is in ``gone``; only rows that a Bloom filter of it lets pass are shuffled."""
    may, rest = bloom.apart(rows, key, gone)
    return rest.unionByName(may.join(gone, key, "left_anti"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    row = store.unused(docs, "_loam_row")
    rows = docs.withColumn(row, F.monotonically_increasing_id())
    judged = decontaminate.contamination(rows.select(F.col(row).alias("doc_id"), "text"), store.table(spark, sf_dir, "benchmark"))
    bad = store.materialize(judged.where("contaminated").select(F.col("doc_id").alias(row)), "contaminated")
    return without(rows, row, bad).drop(row)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", pii_stage),
    ("packing", packing_stage),
]

#: Trained and iterative stages have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = store.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store.materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
