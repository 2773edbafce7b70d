"""Robust aggregation of client updates in long form (round, client_id, param, idx, weight, num_samples)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.statistics import lower_median, trimmed_mean

CELL = ("round", "param", "idx")


def fresh(updates: DataFrame, current_round: int, staleness: int) -> DataFrame:
    return updates.where(F.lit(current_round) - F.col("round") <= staleness)


def averaged(updates: DataFrame) -> DataFrame:
    return updates.groupBy(*CELL).agg((F.sum(F.col("weight") * F.col("num_samples")) / F.sum("num_samples")).alias("weight"))


def median(updates: DataFrame) -> DataFrame:
    return updates.groupBy(*CELL).agg(lower_median(F.col("weight")).alias("weight"))


def trimmed(updates: DataFrame, share: float = 0.2) -> DataFrame:
    return updates.groupBy(*CELL).agg(trimmed_mean(F.col("weight"), share).alias("weight"))


def krum(updates: DataFrame, byzantine: int = 1) -> DataFrame:
    """The update of the client whose nearest others are closest in sum: n - f - 2 of them and one more."""
    a = updates.select("round", "param", "idx", F.col("client_id").alias("a"), F.col("weight").alias("wa"))
    b = updates.select("round", "param", "idx", F.col("client_id").alias("b"), F.col("weight").alias("wb"))
    far = a.join(b, ["round", "param", "idx"]).where("a <> b").groupBy("round", "a", "b").agg(F.sum(F.pow(F.col("wa") - F.col("wb"), F.lit(2))).alias("d2"))
    n = F.count("*").over(Window.partitionBy("round", "a")) + 1
    rank = F.row_number().over(Window.partitionBy("round", "a").orderBy("d2", "b"))
    near = far.withColumns({"n": n, "rank": rank}).where(F.col("rank") <= F.greatest(F.lit(1), F.col("n") - byzantine - 2 + 1))
    sums = near.groupBy("round", "a").agg(F.sum(F.sqrt("d2")).alias("score"))
    best = sums.groupBy("round").agg(F.min_by("a", F.struct("score", "a")).alias("client_id"))
    return updates.join(best, ["round", "client_id"], "left_semi")


def round_metrics(updates: DataFrame) -> DataFrame:
    """Clients, samples and mean loss of each round, a client counted once."""
    one = updates.groupBy("round", "client_id").agg(F.max("num_samples").alias("num_samples"), F.max("loss").alias("loss"))
    return one.groupBy("round").agg(F.count("*").alias("clients"), F.sum("num_samples").alias("samples"), F.avg("loss").alias("loss"))


#: Aggregations by name; others can be added.
STRATEGIES = {"average": averaged, "median": median, "trimmed": trimmed, "krum": krum}


def aggregated(updates: DataFrame, strategy: str, **options) -> DataFrame:
    """(round, param, idx, weight) by the named strategy."""
    return STRATEGIES[strategy](updates, **options).select(*CELL, "weight")
