"""Dataset statistics, exact deterministic splits, and sinks with metadata."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dataset_statistics(examples: DataFrame) -> DataFrame:
    n = F.count("*")
    tokens = F.coalesce(F.sum("estimated_tokens"), F.lit(0))
    kinds = [F.count_if(F.col("format_type") == k).alias(k) for k in ("chatml", "alpaca", "preference", "raw")]
    return examples.agg(
        n.alias("total"), *kinds, F.count_if("is_correction").alias("corrections"), F.count_if("is_synthetic").alias("synthetic"),
        F.round(F.avg("quality_score"), 6).alias("avg_quality"), tokens.alias("total_tokens"), F.floor(F.try_divide(tokens, n)).alias("avg_tokens"),
    )


def ingestion_statistics(interactions: DataFrame) -> DataFrame:
    """Counts by source, by outcome and in all, in one pass."""
    return interactions.groupingSets([["source_type"], ["outcome"], []], "source_type", "outcome").agg(F.count("*").alias("n"))


def split(df: DataFrame, key: str, train: float = 0.9, seed: int = 42) -> DataFrame:
    """Exactly int(n * train) rows are ``train``, chosen by a seeded hash of the key.

    The place in hash order comes from counts of hash buckets, so no task sorts all rows.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    rows = df.withColumns({"_h": digest, "_bucket": F.conv(F.substring(digest, 1, 3), 16, 10).cast("int")})
    sizes = rows.groupBy("_bucket").agg(F.count("*").alias("_size"))  # at most 4096 rows
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"), F.sum("_size").over(Window.partitionBy()).alias("_all"))
    placed = rows.join(F.broadcast(starts), "_bucket").withColumn("_place", F.col("_before") + F.row_number().over(Window.partitionBy("_bucket").orderBy("_h", key)))
    return placed.withColumn("split", F.when(F.col("_place") <= F.floor(F.col("_all") * F.lit(train)), "train").otherwise("validation")).drop("_h", "_bucket", "_before", "_all", "_place")


def save_jsonl(df: DataFrame, folder: str, name: str, **config) -> dict:
    """A folder of JSON lines for each split that has rows, and metadata; returns the metadata."""
    counts = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    for part in ("train", "validation"):
        df.where(F.col("split") == part).drop("split").write.mode("overwrite").json(f"{folder}/{name}_{part}.jsonl")
    meta = {"name": name, "version": "1.0.0", "splits": counts, "config": config}
    df.sparkSession.createDataFrame([(json.dumps(meta, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/{name}_metadata.json")
    return meta


def save_parquet(df: DataFrame, folder: str, name: str) -> None:
    df.write.mode("overwrite").partitionBy("split").parquet(f"{folder}/{name}")


def upsert(current: DataFrame, changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Changes replace rows of the same key; of several changes the latest by ``order`` wins."""
    rows = current.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    latest = Window.partitionBy(*keys).orderBy(F.desc("_new"), F.desc(order))
    return rows.withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n", "_new")


def delete(current: DataFrame, keys: DataFrame) -> DataFrame:
    return current.join(keys.distinct(), keys.columns, "left_anti")


def append_audit(df: DataFrame, folder: str) -> None:
    df.write.mode("append").json(folder)


def new_version(history: DataFrame, config: str) -> DataFrame:
    """``history`` (version, digest, config) with the configuration as its next version."""
    nxt = history.agg((F.coalesce(F.max("version"), F.lit(0)) + 1).cast("int").alias("version")).select("version", F.sha2(F.lit(config), 256).alias("digest"), F.lit(config).alias("config"))
    return history.unionByName(nxt)


def current_version(history: DataFrame) -> DataFrame:
    return history.agg(F.max("version").alias("version"), F.max_by("config", "version").alias("config"))


def rolled_back(history: DataFrame, version: int) -> DataFrame:
    """An old configuration as a new version."""
    old = history.where(F.col("version") == version).select("digest", "config")
    nxt = history.agg((F.max("version") + 1).cast("int").alias("version")).crossJoin(old)  # one row each
    return history.unionByName(nxt.select("version", "digest", "config"))


def save_each(df: DataFrame, folder: str) -> None:
    """A JSON file for each row."""
    df.write.mode("append").option("maxRecordsPerFile", 1).json(folder)


def save_state(df: DataFrame, folder: str, version: int) -> None:
    """A state under a version of its own: readers of ``latest_state`` see the last whole one, a write that failed is not seen."""
    df.write.mode("overwrite").json(f"{folder}/version={version:012d}")


def latest_state(spark, folder: str, schema: str) -> DataFrame:
    """The last state whose write ended; an empty frame if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/version=*/_SUCCESS"))  # a file for each version
    done = sorted(f.getPath().getParent().toString() for f in found or [])
    return spark.read.schema(schema).json(done[-1]) if done else spark.createDataFrame([], schema)
