"""Evaluation roll-ups, comparisons, A/B tests and approval."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scores import compares
from ..functions.statistics import t_statistic

CRITICAL_T = 1.959963985
#: Metrics for which less is better.
LOWER_IS_BETTER = ("latency", "error_rate", "loss")


def overall(metrics: DataFrame) -> DataFrame:
    """Mean value, and whether all that have a verdict passed, of each run."""
    return metrics.groupBy("run_id").agg(F.avg("value").alias("score"), F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"), F.count("*").alias("metrics"))


def composite(metrics: DataFrame) -> DataFrame:
    """Metrics of several evaluators under ``evaluator/metric`` names."""
    return metrics.withColumn("metric", F.concat_ws("/", "evaluator", "metric"))


def compare(baseline: DataFrame, candidate: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """Baseline metrics with the candidate's; a regression is an absolute drop beyond the tolerance."""
    c = candidate.select("metric", F.col("value").alias("candidate"))
    rows = baseline.select("metric", F.col("value").alias("baseline")).join(c, "metric", "left")
    diff = F.col("candidate") - F.col("baseline")
    return rows.withColumns({"diff": diff, "pct_change": F.when(F.col("baseline") != 0, diff / F.col("baseline") * 100), "regression": F.coalesce(diff < -tolerance, F.lit(False))})


def criteria_results(criteria: DataFrame, metrics: DataFrame) -> DataFrame:
    """Each criterion with its metric, by exact name or as ``evaluator/name``; a missing one fails if required."""
    m = metrics.select("run_id", F.col("metric").alias("found"), "value", F.regexp_extract("metric", "([^/]+)$", 1).alias("tail"))
    runs = metrics.select("run_id").distinct()
    both = runs.crossJoin(F.broadcast(criteria))  # criteria are a configuration of a few rows
    hits = both.join(m, ["run_id"]).where((F.col("found") == F.col("metric")) | (F.col("tail") == F.col("metric")))
    best = hits.groupBy("run_id", "name").agg(F.min_by("value", F.struct(F.col("found") != F.col("metric"), "found")).alias("value"))
    rows = both.join(best, ["run_id", "name"], "left")
    return rows.withColumn("ok", F.when(F.col("value").isNull(), ~F.col("required")).otherwise(compares(F.col("value"), F.col("comparison"), F.col("threshold"))))


def approval(results: DataFrame, regressions: DataFrame | None = None, with_baseline: bool = True) -> DataFrame:
    """approved, rejected or pending_review for each run."""
    rows = results.groupBy("run_id").agg(F.avg(F.col("ok").cast("int")).alias("pass_rate"), F.count_if(F.col("required") & ~F.col("ok")).alias("required_failed"))
    rows = rows.withColumn("regressed", F.lit(False)) if regressions is None else rows.join(regressions.select("run_id", "regressed"), "run_id", "left").fillna({"regressed": False})
    rate = F.col("pass_rate")
    status = F.when((F.col("required_failed") > 0) | F.col("regressed"), "rejected").when(~F.lit(with_baseline), "pending_review").when(rate >= 0.8, "approved").when(rate >= 0.6, "pending_review").otherwise("rejected")
    return rows.withColumn("status", status)


def pass_rates(results: DataFrame, category: str = "category") -> DataFrame:
    """Passed share and mean score, in all and by category, in one pass."""
    return results.groupingSets([[category], []], category).agg(F.avg(F.col("passed").cast("int")).alias("pass_rate"), F.avg("score").alias("avg_score"), F.count("*").alias("n"))


def pass_at_k(results: DataFrame, k: int) -> DataFrame:
    """Tasks solved by one of their first k attempts."""
    tried = results.groupBy("task").agg(F.transform(F.sort_array(F.collect_list(F.struct("attempt", "passed"))), lambda x: x["passed"]).alias("runs"))
    return tried.agg(F.avg(F.exists(F.slice("runs", 1, k), lambda x: x).cast("int")).alias("pass_at_k"), F.count("*").alias("tasks"))


def weighted_score(scores: DataFrame, weights: dict[str, float]) -> DataFrame:
    table = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
    w = F.try_element_at(table, F.col("benchmark"))
    return scores.groupBy("model").agg((F.sum(F.col("score") * w) / F.sum(w)).alias("overall"))


def ab_result(samples: DataFrame, keys: tuple[str, ...] = ("test_id",)) -> DataFrame:
    """Means, deviations, t and winner of variants a and b; significance by the critical t of 95 %."""
    one = samples.groupBy(*keys, "variant").agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("sd"))
    side = lambda v: one.where(F.col("variant") == v).select(*keys, *[F.col(c).alias(f"{c}_{v}") for c in ("n", "mean", "sd")])
    rows = side("a").join(side("b"), list(keys))
    t = t_statistic(F.col("mean_a"), F.col("sd_a"), F.col("n_a"), F.col("mean_b"), F.col("sd_b"), F.col("n_b"))
    rows = rows.withColumn("t", t).withColumn("significant", F.coalesce(F.abs("t") > CRITICAL_T, F.lit(False)))
    return rows.withColumn("winner", F.when(F.col("significant") & (F.col("mean_a") > F.col("mean_b")), "a").when(F.col("significant") & (F.col("mean_b") > F.col("mean_a")), "b"))


def registry_ab(samples: DataFrame, least: int = 10) -> DataFrame:
    """Per metric: improvement of b over a with the sign that is better, and t > 2."""
    rows = ab_result(samples.withColumnRenamed("test_id", "test"), ("test", "metric"))
    gain = F.when(F.col("mean_a") != 0, (F.col("mean_b") - F.col("mean_a")) / F.col("mean_a") * 100)
    gain = F.when(F.col("metric").isin(*LOWER_IS_BETTER), -gain).otherwise(gain)
    same = (F.col("sd_a") == 0) & (F.col("sd_b") == 0)
    enough = (F.col("n_a") >= least) & (F.col("n_b") >= least)
    return rows.withColumns({"improvement": gain, "significant": enough & F.when(same, F.abs(F.col("mean_a") - F.col("mean_b")) > 0.01).otherwise(F.coalesce(F.abs("t") > 2.0, F.lit(False)))}).drop("winner")


def majority(votes: DataFrame) -> DataFrame:
    """The most frequent answer of each request; of equal ones the first seen."""
    counted = votes.groupBy("request", "answer").agg(F.count("*").alias("n"), F.min("ord").alias("first"), F.min("latency_ms").alias("fastest"))
    return counted.groupBy("request").agg(F.max_by("answer", F.struct("n", (-F.col("first")).alias("o"))).alias("answer"), F.max("n").alias("votes"), F.min("fastest").alias("fastest_ms"))


def choice_prompt(question: Column, choices: Column) -> Column:
    """A question with its choices by letter."""
    lines = F.transform(choices, lambda c, i: F.concat(F.chr(65 + i), F.lit(". "), c))
    return F.concat(question, F.lit("\n"), F.array_join(lines, "\n"), F.lit("\nAnswer:"))


def choice_answer(reply: Column) -> Column:
    """The first of A to D among the first two visible characters of a reply; null if there is none."""
    return F.nullif(F.regexp_extract(F.substring(F.upper(F.trim(reply)), 1, 2), "([A-D])", 1), F.lit(""))


def evaluated(cases: DataFrame, predicates: dict[str, Callable[[Column], Column]], name: str = "evaluator", reply: str = "reply") -> DataFrame:
    """``passed`` for each case by the predicate that it names, a column expression; null where it names none."""
    passed = F.lit(None).cast("boolean")
    for key, predicate in predicates.items():
        passed = F.when(F.col(name) == key, predicate(F.col(reply))).otherwise(passed)
    return cases.withColumn("passed", passed)
