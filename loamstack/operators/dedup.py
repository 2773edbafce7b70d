"""Exact and embedding-based deduplication."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..rounds import drop, kept


def first_of(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """The first row of each key in order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def quality_then_first(df: DataFrame, condition, keys: list[str], *order) -> DataFrame:
    """Only rows that pass may hold a key."""
    return first_of(df.where(condition), keys, *order)


def first_then_quality(df: DataFrame, condition, keys: list[str], *order) -> DataFrame:
    """A key is taken by its first row, passing or not."""
    return first_of(df, keys, *order).where(condition)


def new_only(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(known.select(*keys).distinct(), keys, "left_anti")


def similar_pairs(vectors: DataFrame, threshold: float, key: str = "vec_id", vector: str = "embedding", block_rows: int = 4096) -> DataFrame:
    """(a, b, cosine), a < b, of all pairs from the threshold on; zero vectors have none.

    Vectors are dealt into blocks of about ``block_rows`` and each pair of blocks is one matrix
    product, so no row-by-row cross join is made and a task holds two blocks, however many there are.
    """
    blocks = max(1, -(-vectors.count() // block_rows))
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    unit = vectors.select(F.col(key).alias("id"), F.col(vector).alias("v"), norm.alias("norm")).where("norm > 0")
    unit = unit.select("id", F.transform("v", lambda x: x / F.col("norm")).alias("v"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"))
    sent = unit.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    sent = sent.select("id", "v", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"))

    def product(key_, rows: pd.DataFrame) -> pd.DataFrame:
        p, q = int(key_[0]), int(key_[1])
        left, right = rows[rows["block"] == p], rows[rows["block"] == q]
        if left.empty or right.empty:
            return pd.DataFrame({"a": [], "b": [], "cosine": []})
        m = np.stack(left["v"]) @ np.stack(right["v"]).T
        i, j = np.nonzero(m >= threshold)
        x, y = left["id"].to_numpy()[i], right["id"].to_numpy()[j]
        keep = (x < y) if p == q else np.ones(len(x), bool)
        return pd.DataFrame({"a": np.minimum(x, y)[keep], "b": np.maximum(x, y)[keep], "cosine": m[i, j][keep]})

    return sent.groupBy("p", "q").applyInPandas(product, "a long, b long, cosine double")


def greedy_kept(ids: DataFrame, pairs: DataFrame, key: str = "vec_id") -> DataFrame:
    """``key`` and ``kept``: a row is dropped if it is similar to an earlier row that is kept.

    Rounds: rows without an undecided earlier neighbour are kept, their later neighbours dropped.
    """
    pairs = kept(pairs.select("a", "b"), "pairs")
    dropped = None
    live = pairs
    while not live.isEmpty():
        blocked = live.select(F.col("b").alias("id")).distinct()
        heads = live.select(F.col("a").alias("id")).distinct().join(blocked, "id", "left_anti")
        gone = kept(live.join(heads.withColumnRenamed("id", "a"), "a", "left_semi").select(F.col("b").alias("id")).distinct(), "gone")
        dropped = gone if dropped is None else dropped.unionByName(gone)
        before = live
        live = live.join(gone.withColumnRenamed("id", "a"), "a", "left_anti").join(gone.withColumnRenamed("id", "b"), "b", "left_anti")
        live = kept(live.join(heads.withColumnRenamed("id", "a"), "a", "left_anti"), "live")
        drop(before)
    out = ids.select(key)
    if dropped is None:
        return out.withColumn("kept", F.lit(True))
    marks = dropped.select(F.col("id").alias(key), F.lit(False).alias("kept")).distinct()
    return out.join(marks, key, "left").withColumn("kept", F.coalesce("kept", F.lit(True)))


def hybrid(texts: DataFrame, pairs: DataFrame, key: str, text: str) -> DataFrame:
    """Exact, then greedy semantic deduplication of what is left; ``pairs`` are (a, b) of keys."""
    exact = first_of(texts, [text], key)
    left = exact.select(key)
    inside = pairs.join(left.withColumnRenamed(key, "a"), "a", "left_semi").join(left.withColumnRenamed(key, "b"), "b", "left_semi")
    kept = greedy_kept(left, inside, key).where("kept").select(key)
    return exact.join(kept, key, "left_semi")
