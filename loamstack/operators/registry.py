"""Model versions, checkpoints, routing and shutdown plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import semantic_version
from ..functions.scores import prompt_complexity


def latest(versions: DataFrame, *keys: str) -> DataFrame:
    return versions.groupBy(*keys).agg(F.max_by("version", semantic_version(F.col("version"))).alias("version"))


def deployed(versions: DataFrame, *keys: str) -> DataFrame:
    return latest(versions.where("status = 'deployed'"), *keys)


def listed(versions: DataFrame, model: str | None = None, status: str | None = None, limit: int = 100) -> DataFrame:
    if model is not None:
        versions = versions.where(F.col("model") == model)
    if status is not None:
        versions = versions.where(F.col("status") == status)
    return versions.orderBy(F.desc(semantic_version(F.col("version")))).limit(limit)


def retained_versions(versions: DataFrame, keep: int) -> DataFrame:
    """The latest of each model, and all that are deployed or staged."""
    n = F.row_number().over(Window.partitionBy("model").orderBy(F.desc(semantic_version(F.col("version")))))
    return versions.withColumn("_n", n).where((F.col("_n") <= keep) | F.col("status").isin("deployed", "staged")).drop("_n")


def with_capabilities(models: DataFrame, any_tags: list[str] | None = None, all_capabilities: list[str] | None = None) -> DataFrame:
    if any_tags:
        models = models.where(F.arrays_overlap("tags", F.array(*map(F.lit, any_tags))))
    if all_capabilities:
        models = models.where(F.size(F.array_except(F.array(*map(F.lit, all_capabilities)), "capabilities")) == 0)
    return models


def best_checkpoint(checkpoints: DataFrame, metric: str, lower_is_better: bool = True) -> DataFrame:
    """The run's checkpoint with the best value; a missing one is the worst."""
    v = F.coalesce(F.col(metric), F.lit(float("inf") if lower_is_better else float("-inf")))
    pick = F.min_by if lower_is_better else F.max_by
    return checkpoints.groupBy("run").agg(pick("checkpoint", v).alias("checkpoint"))


def kept_checkpoints(checkpoints: DataFrame, metric: str, best: int = 3, recent: int = 2) -> DataFrame:
    by = lambda *o: F.row_number().over(Window.partitionBy("run").orderBy(*o))
    rows = checkpoints.withColumns({"_b": by(F.asc_nulls_last(metric), "step"), "_r": by(F.desc("step"))})
    return rows.where((F.col("_b") <= best) | (F.col("_r") <= recent)).drop("_b", "_r")


def removed_checkpoints(checkpoints: DataFrame, kept: DataFrame) -> DataFrame:
    return checkpoints.join(kept.select("run", "checkpoint"), ["run", "checkpoint"], "left_anti")


def latest_by_number(names: DataFrame, name: str = "name") -> DataFrame:
    """The name with the largest number at its end."""
    number = F.regexp_extract(name, r"(\d+)$", 1).try_cast("bigint")
    return names.agg(F.max_by(name, number).alias(name), F.max(number).alias("step"))


def best_model(models: DataFrame, here: str, most_memory_gb: float | None = None, most_latency_ms: float | None = None, capabilities: list[str] | None = None) -> DataFrame:
    """Local first, then much used, then fast; equal ones in their order."""
    rows = with_capabilities(models.where("status = 'available'"), all_capabilities=capabilities)
    if most_memory_gb:
        rows = rows.where(F.col("memory_gb") <= most_memory_gb)
    if most_latency_ms:
        rows = rows.where(F.col("latency_ms") <= most_latency_ms)
    score = F.when(F.col("repository") == here, 1000.0).otherwise(0.0) + F.col("loads") * 10.0 - F.when(F.col("latency_ms") > 0, F.col("latency_ms")).otherwise(0.0)
    return rows.withColumn("score", score).orderBy(F.desc("score"), "ord").limit(1)


#: Weights of the factors under each strategy.
STRATEGIES = {
    "quality": {"capability": 0.5, "latency": 0.1, "cost": 0.1, "availability": 0.2, "memory": 0.1},
    "latency": {"capability": 0.2, "latency": 0.5, "cost": 0.05, "availability": 0.15, "memory": 0.1},
    "cost": {"capability": 0.2, "latency": 0.1, "cost": 0.5, "availability": 0.1, "memory": 0.1},
    "balanced": {"capability": 0.3, "latency": 0.2, "cost": 0.2, "availability": 0.2, "memory": 0.1},
}


def routed(prompts: DataFrame, models: DataFrame, strategy: str = "balanced", fallbacks: int = 3) -> DataFrame:
    """The model of highest weighted score for each prompt, and the next ones as fallbacks.

    ``models`` is a configuration of a few rows with capacity, latency_ms, price, available and memory_fit in 0..1.
    """
    w = STRATEGIES[strategy]
    rows = prompts.withColumn("complexity", prompt_complexity(F.col("prompt"))).join(F.broadcast(models))
    factors = {
        "capability": F.when(F.col("capacity") >= F.col("complexity"), 1.0).otherwise(F.col("capacity") / F.col("complexity")), "latency": F.greatest(F.lit(0.0), 1 - F.col("latency_ms") / 5000),
        "cost": F.greatest(F.lit(0.0), 1 - F.col("price") / 0.05), "availability": F.when(F.col("available"), 1.0).otherwise(0.3), "memory": F.col("memory_fit"),
    }
    total = sum((factors[k] * v for k, v in w.items()), F.lit(0.0)) / sum(w.values())
    ranked = F.slice(F.sort_array(F.collect_list(F.struct((-F.round("total", 9)).alias("s"), "model_id"))), 1, fallbacks + 1)
    out = rows.withColumn("total", total).groupBy("prompt_id").agg(ranked.alias("r"), F.max("complexity").alias("complexity"))
    return out.select("prompt_id", F.round("complexity", 6).alias("complexity"), F.col("r")[0]["model_id"].alias("model_id"), (-F.col("r")[0]["s"]).alias("score"), F.transform(F.slice("r", 2, fallbacks), lambda x: x["model_id"]).alias("fallbacks"))


def shutdown_plan(components: DataFrame, seconds_per_layer: float = 5.0) -> DataFrame:
    """Active components by layer, the last layer first, with the time at which each layer starts."""
    layers = components.where("active").groupBy("layer").agg(F.array_sort(F.collect_list("component")).alias("components"))
    n = F.row_number().over(Window.orderBy(F.desc("layer")))  # a row for each layer
    return layers.withColumn("starts_at", (n - 1) * F.lit(seconds_per_layer))


def admitted(jobs: DataFrame, slots: int) -> DataFrame:
    return jobs.where("status = 'queued'").orderBy(F.desc("priority"), "created_at").limit(slots)


def drained(queue: DataFrame, capacity: int) -> DataFrame:
    """By priority, first in first out; beyond the capacity the newest of the lowest priority goes."""
    return queue.orderBy("priority", "seq").limit(capacity)


def newest(rows: DataFrame, order: str, limit: int, condition: Column | None = None) -> DataFrame:
    return (rows if condition is None else rows.where(condition)).orderBy(F.desc(order)).limit(limit)


def longest_chain(dependencies: DataFrame) -> DataFrame:
    """Number of steps of the longest chain of dependencies (source, target), which bounds how soon all can be down."""
    from .graph import topological

    return topological(dependencies).agg(F.max("depth").alias("steps"), F.count("*").alias("components"))
