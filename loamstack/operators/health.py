"""Incidents, uptime, SLA, alerts and failure streaks from health checks (component, ts, status, latency_ms)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import series

UNHEALTHY, HEALTHY, DEGRADED = "unhealthy", "healthy", "degraded"


def transitions(checks: DataFrame, *tie: str) -> DataFrame:
    w = Window.partitionBy("component").orderBy("ts", *tie)
    return checks.withColumn("before", F.lag("status").over(w)).where("before IS NULL OR before <> status")


def incidents(checks: DataFrame, *tie: str) -> DataFrame:
    """An incident opens on a change to unhealthy; a direct change from unhealthy to healthy closes the latest one."""
    w = Window.partitionBy("component").orderBy("ts", *tie)
    rows = checks.withColumn("before", F.lag("status").over(w))
    rows = rows.where(((F.col("status") == UNHEALTHY) & (F.coalesce("before", F.lit("")) != UNHEALTHY)) | ((F.col("status") == HEALTHY) & (F.col("before") == UNHEALTHY)))
    rows = rows.withColumns({"next_status": F.lead("status").over(w), "next_ts": F.lead("ts").over(w)})
    closed = F.when(F.col("next_status") == HEALTHY, F.col("next_ts"))
    return rows.where(F.col("status") == UNHEALTHY).select("component", F.col("ts").alias("started"), closed.alias("resolved"), ((F.unix_micros(closed) - F.unix_micros("ts")) / 1e6).alias("seconds"))


def uptime(checks: DataFrame) -> DataFrame:
    """Share of healthy and degraded checks."""
    return checks.groupBy("component").agg((F.avg(F.col("status").isin(HEALTHY, DEGRADED).cast("int")) * 100).alias("uptime_percent"))


def sla(checks: DataFrame, now, period_seconds: int | None = None, target: float = 99.9, *tie: str) -> DataFrame:
    """Everything but unhealthy counts as up; open incidents last until ``now``."""
    if period_seconds is not None:
        checks = checks.where(F.unix_micros("ts") > F.unix_micros(now) - period_seconds * 1_000_000)
    up = checks.groupBy("component").agg(
        F.count("*").alias("checks"), (F.avg((F.col("status") != UNHEALTHY).cast("int")) * 100).alias("uptime_percent"), F.avg("latency_ms").alias("avg_latency_ms"), F.percentile("latency_ms", 0.99).alias("p99_latency_ms")
    )
    down = incidents(checks, *tie).groupBy("component").agg(F.count("*").alias("incidents"), F.sum(F.coalesce("seconds", (F.unix_micros(now) - F.unix_micros("started")) / 1e6)).alias("downtime_seconds"))
    rows = up.join(down, "component", "left").fillna({"incidents": 0, "downtime_seconds": 0.0})
    return rows.withColumn("compliant", F.col("uptime_percent") >= target)


def failure_streaks(checks: DataFrame, *tie: str) -> DataFrame:
    """Number of unhealthy checks in a row up to each check."""
    w = Window.partitionBy("component").orderBy("ts", *tie)
    rows = checks.withColumn("_run", F.sum((F.col("status") != UNHEALTHY).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy("component", "_run").orderBy("ts", *tie)
    streak = F.sum((F.col("status") == UNHEALTHY).cast("int")).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("failures", streak).drop("_run")


def circuit_open(checks: DataFrame, failures: int = 5, *tie: str) -> DataFrame:
    return failure_streaks(checks, *tie).withColumn("open", F.col("failures") >= failures)


def alert_candidates(checks: DataFrame, *tie: str) -> DataFrame:
    """Changes of status that would alert, with their severity."""
    w = Window.partitionBy("component").orderBy("ts", *tie)
    rows = checks.withColumn("before", F.coalesce(F.lag("status").over(w), F.lit("unknown"))).where("status <> before OR before = 'unknown'")
    severity = F.when(F.col("status") == UNHEALTHY, "error").when(F.col("status") == DEGRADED, "warning").when(F.col("before").isin(UNHEALTHY, DEGRADED), "info")
    return rows.withColumn("severity", severity).where("severity IS NOT NULL")


def alerts(checks: DataFrame, cooldown: float = 300.0, *tie: str) -> DataFrame:
    """Candidates that are not within the cooldown of the last alert fired; a component with very many is worked on in parts."""
    found = alert_candidates(checks, *tie).select("component", "ts", "before", "status", "severity")
    return series.after_cooldown(found, ["component"], "ts", cooldown)


def latency_trend(checks: DataFrame, last: int = 100, *tie: str) -> DataFrame:
    w = Window.partitionBy("component").orderBy(F.desc("ts"), *[F.desc(t) for t in tie])
    rows = checks.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= last)
    return rows.groupBy("component").agg(F.avg("latency_ms").alias("mean_ms"), F.percentile("latency_ms", 0.95).alias("p95_ms"), F.count("*").alias("n"))


def overall(checks: DataFrame) -> DataFrame:
    """Worst latest status of all components."""
    last = checks.groupBy("component").agg(F.max_by("status", "ts").alias("status"))
    rank = F.when(F.col("status") == UNHEALTHY, 3).when(F.col("status") == DEGRADED, 2).when(F.col("status") == HEALTHY, 1).otherwise(0)
    return last.agg(F.max_by("status", rank).alias("overall"), F.count("*").alias("components"), F.count_if(F.col("status") == UNHEALTHY).alias("unhealthy"))


def summary(states: DataFrame, state: str, role: str) -> DataFrame:
    """Number of components by state and by role, in one pass."""
    return states.groupingSets([[state], [role]], state, role).agg(F.count("*").alias("n"))
