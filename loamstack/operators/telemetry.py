"""Windowed metrics, rolling anomalies and drift, correlation, sampling and gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import unit_interval
from ..functions.statistics import change_severity, index_percentile, percentiles, t_statistic

WINDOWS = (60, 300, 3600)


def windowed(metrics: DataFrame, seconds: int = 60, keys: tuple[str, ...] = ("name",), with_percentiles: bool = True, slide: int | None = None) -> DataFrame:
    """Count, sum, mean, extremes and percentiles by epoch-aligned windows of event time."""
    window = F.window("ts", f"{seconds} seconds", *([f"{slide} seconds"] if slide else []))
    aggs = [F.count("*").alias("n"), F.sum("value").alias("total"), F.avg("value").alias("mean"), F.min("value").alias("low"), F.max("value").alias("high")]
    if with_percentiles:
        aggs.append(percentiles(F.col("value")).alias("p"))
    rows = metrics.groupBy(window.alias("w"), *keys).agg(*aggs)
    cols = [F.col("w.start").alias("window_start"), *keys, "n", "total", "mean", "low", "high"]
    if with_percentiles:
        cols += [F.col("p")[k].alias(name) for k, name in enumerate(("p50", "p90", "p95", "p99"))]
    return rows.select(*cols)


def rolled_up(minutes: DataFrame, seconds: int, keys: tuple[str, ...] = ("name",)) -> DataFrame:
    """Larger windows from smaller ones, for the measures that add up."""
    rows = minutes.groupBy(F.window("window_start", f"{seconds} seconds").alias("w"), *keys).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"))
    return rows.select(F.col("w.start").alias("window_start"), *keys, "n", "total", (F.col("total") / F.col("n")).alias("mean"), "low", "high")


def collector_statistics(metrics: DataFrame, keys: tuple[str, ...], last: int | None = 1000, *order: str) -> DataFrame:
    """Statistics of the last values of each key, with index percentiles."""
    if last:
        metrics = metrics.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(o) for o in order]))).where(F.col("_n") <= last)
    v = F.col("value")
    return metrics.groupBy(*keys).agg(
        F.count("*").alias("n"), F.min(v).alias("low"), F.max(v).alias("high"), F.avg(v).alias("mean"), F.median(v).alias("median"), F.stddev_samp(v).alias("sd"),
        *[index_percentile(v, p).alias(f"p{int(p * 100)}") for p in (0.5, 0.9, 0.95, 0.99)],
    )


def counters(changes: DataFrame, *keys: str) -> DataFrame:
    return changes.groupBy(*keys).agg(F.sum("change").alias("count"))


def gauges(points: DataFrame, *keys: str) -> DataFrame:
    return points.groupBy(*keys).agg(F.max_by("value", "ts").alias("value"))


def _recent(keys: tuple[str, ...], order: tuple[str, ...], n: int):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(n - 1), 0)


def split_recent(metrics: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], span: int, seconds: int) -> DataFrame:
    """``metrics`` in parts (``_part``) of so much time of ``ts``, each with the ``span`` - 1 rows before it (``_own`` is false).

    A window over the last ``span`` rows can then be by part, so a metric that has most rows is
    many tasks.  Only the last rows of each part, which are few, are ordered by metric to find what comes before.
    """
    part = F.floor(F.unix_seconds("ts") / seconds).alias("_part")
    rows = metrics.select("*", part, F.lit(True).alias("_own"))
    last = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*[F.desc(o) for o in order]))
    tails = rows.withColumn("_last", last).where(F.col("_last") < span).drop("_last")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_part", *order))
    tails = tails.withColumn("_place", place)
    starts = tails.groupBy(*keys, "_part").agg(F.min("_place").alias("_start")).withColumnRenamed("_part", "_next")
    # The rows before a start lie in its block of ``span`` places or in the one before.
    block = F.floor(F.col("_place") / span).alias("_block")
    wanted = starts.withColumn("_block", F.explode(F.array(F.floor(F.col("_start") / span), F.floor(F.col("_start") / span) - 1)))
    before = tails.select("*", block).join(wanted, [*keys, "_block"]).where((F.col("_place") < F.col("_start")) & (F.col("_place") >= F.col("_start") - (span - 1)))
    before = before.select(*metrics.columns, F.col("_next").alias("_part"), F.lit(False).alias("_own"))
    return rows.unionByName(before)


def anomalies(metrics: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], span: int = 100, least: int = 20, limit: float = 3.0, split_seconds: int | None = None) -> DataFrame:
    """Points further than ``limit`` deviations from the mean of the last values, themselves included; half as much again is critical.

    With ``split_seconds`` (and order beginning with ``ts``) each metric is worked on in parts of so much time.
    """
    rows = metrics if split_seconds is None else split_recent(metrics, keys, order, span, split_seconds)
    w = _recent(keys if split_seconds is None else (*keys, "_part"), order, span)
    rows = rows.withColumns({"mean": F.avg("value").over(w), "sd": F.stddev_samp("value").over(w), "samples": F.count("value").over(w)})
    rows = rows if split_seconds is None else rows.where("_own").drop("_own", "_part")
    rows = rows.where((F.col("samples") >= least) & (F.col("sd") > 0)).withColumn("z", (F.col("value") - F.col("mean")) / F.col("sd"))
    return rows.where(F.abs("z") > limit).withColumn("severity", F.when(F.abs("z") > limit * 1.5, "critical").otherwise("warning"))


def drift(metrics: DataFrame, baseline: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], span: int = 100, least: int = 30, critical_t: float = 1.959963985, split_seconds: int | None = None) -> DataFrame:
    """Last values against a baseline (keys, base_mean, base_sd); significance by the critical t of p = 0.05; in parts as for ``anomalies``."""
    rows = metrics if split_seconds is None else split_recent(metrics, keys, order, span, split_seconds)
    w = _recent(keys if split_seconds is None else (*keys, "_part"), order, span)
    rows = rows.withColumns({"mean": F.avg("value").over(w), "sd": F.coalesce(F.stddev_samp("value").over(w), F.lit(0.0)), "samples": F.count("value").over(w)})
    rows = rows if split_seconds is None else rows.where("_own").drop("_own", "_part")
    rows = rows.where(F.col("samples") >= least).join(F.broadcast(baseline), list(keys))  # a row for each metric
    rows = rows.withColumns({
        "t": t_statistic(F.col("mean"), F.col("sd"), F.col("samples"), F.col("base_mean"), F.col("base_sd"), F.lit(span)),
        "change_percent": F.when(F.col("base_mean") != 0, (F.col("mean") - F.col("base_mean")) / F.col("base_mean") * 100).otherwise(0.0),
    })
    return rows.where(F.abs("t") > critical_t).withColumn("severity", change_severity(F.col("change_percent")))


def sessions(events: DataFrame, key: str, ts: str = "ts", gap_seconds: int = 3600) -> DataFrame:
    """Chains of a correlation key that end with a gap: first, last and number of events."""
    w = Window.partitionBy(key).orderBy(ts)
    rows = events.withColumn("_gap", F.unix_micros(ts) - F.unix_micros(F.lag(ts).over(w)))
    rows = rows.withColumn("session", F.sum((F.col("_gap").isNull() | (F.col("_gap") >= gap_seconds * 1_000_000)).cast("int")).over(w.rangeBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(key, "session").agg(F.min(ts).alias("started"), F.max(ts).alias("ended"), F.count("*").alias("events"))


def chain(events: DataFrame, key: str, *fields: str) -> DataFrame:
    """The ordered events of each correlation key."""
    return events.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("chain"))


def sampled(metrics: DataFrame, name: str, key: str, seconds: int = 10, target: float = 1000.0, least: float = 0.01) -> DataFrame:
    """Each window's rate decides the share that the next window keeps; which rows, their hash decides."""
    counts = metrics.groupBy(name, F.window("ts", f"{seconds} seconds").alias("w")).agg(F.count("*").alias("n")).select(name, F.col("w.start").alias("start"), "n")
    rate = F.col("n") / seconds
    share = F.when(rate > target, F.greatest(F.lit(least), target / rate)).otherwise(1.0)
    nxt = counts.select(name, F.timestamp_add("SECOND", F.lit(seconds), "start").alias("_start"), share.alias("share"))
    rows = metrics.withColumn("_start", F.window("ts", f"{seconds} seconds")["start"]).join(nxt, [name, "_start"], "left").withColumn("share", F.coalesce("share", F.lit(1.0)))
    return rows.where(unit_interval(F.col(key)) < F.col("share")).drop("_start")


def heartbeat_gaps(beats: DataFrame, component: str, interval: float, allowed: int = 3) -> DataFrame:
    """Silences longer than ``allowed`` intervals, with the number of beats missed."""
    nxt = F.lead("ts").over(Window.partitionBy(component).orderBy("ts"))
    rows = beats.select(component, "ts", nxt.alias("next")).withColumn("gap", (F.unix_micros("next") - F.unix_micros("ts")) / 1e6)
    return rows.where(F.col("gap") > allowed * interval).withColumn("missed", F.floor(F.col("gap") / interval)).withColumn("state", F.when(F.col("missed") >= 5, "dead").otherwise("missed"))


def latest_state(beats: DataFrame, component: str, metrics: str) -> DataFrame:
    return beats.groupBy(component).agg(F.max_by(metrics, "ts").alias(metrics), F.max("ts").alias("seen"))


def performance(requests: DataFrame, *keys: str) -> DataFrame:
    """Success rate, latency by index percentiles, and tokens a second."""
    ms = F.when(F.col("success"), F.col("latency_ms"))
    return requests.groupBy(*keys).agg(
        F.count("*").alias("requests"), F.avg(F.col("success").cast("int")).alias("success_rate"), F.avg(ms).alias("avg_ms"), F.min(ms).alias("min_ms"), F.max(ms).alias("max_ms"),
        *[index_percentile(ms, p).alias(f"p{int(p * 100)}_ms") for p in (0.5, 0.95, 0.99)], (F.sum("tokens") / (F.sum(ms) / 1000)).alias("tokens_per_s"),
    )


def threshold_triggers(counts: DataFrame, key: str, order: str, threshold: int) -> DataFrame:
    """Rows at which the running count of a key first reaches a multiple of the threshold."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("n").over(w)
    return counts.withColumn("total", total).where(F.floor(F.col("total") / threshold) > F.floor((F.col("total") - F.col("n")) / threshold))


def routed(events: DataFrame, me: str) -> DataFrame:
    """Events of others that name this receiver or nobody."""
    return events.where((F.col("source") != me) & ((F.size("target_sources") <= 0) | F.array_contains("target_sources", me)))


def for_topic(messages: DataFrame, topic: str) -> DataFrame:
    """What the subscribers of a topic get: the topic's messages and those for all."""
    return messages.where(F.col("topic").isin(topic, "all"))


def severity_rank(severity: Column) -> Column:
    return F.when(severity == "info", 0).when(severity == "warning", 1).when(severity == "error", 2).when(severity == "critical", 3).otherwise(-1)


def alert_history(alerts: DataFrame, least: str = "info", component: str | None = None, limit: int = 100) -> DataFrame:
    rows = alerts.where(severity_rank(F.col("severity")) >= severity_rank(F.lit(least)))
    if component is not None:
        rows = rows.where(F.col("component") == component)
    return rows.orderBy(F.desc("ts")).limit(limit)


def run_statistics(runs: DataFrame, *keys: str) -> DataFrame:
    """Rates and averages of runs (ok, seconds, attempts, items): of connections, batches, retries or schedules alike."""
    n = F.count("*")
    return runs.groupBy(*keys).agg(
        n.alias("runs"), F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed"), F.avg(F.col("ok").cast("int")).alias("success_rate"), F.avg("seconds").alias("avg_seconds"), F.max("seconds").alias("max_seconds"),
        F.sum(F.col("attempts") - 1).alias("retries"), F.try_divide(F.sum("items"), F.sum("seconds")).alias("items_per_s"),
    )


def progress(fetches: DataFrame, *keys: str) -> DataFrame:
    """How far a run of fetches (status, started, ended) is: counts by status, success among those tried, and the time it took."""
    tried = F.count_if(F.col("status").isin("fetched", "failed"))
    return fetches.groupBy(*keys).agg(
        F.count("*").alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in ("fetched", "failed", "blocked")], F.coalesce(F.try_divide(F.count_if(F.col("status") == "fetched"), tried), F.lit(0.0)).alias("success_rate"),
        ((F.unix_micros(F.max("ended")) - F.unix_micros(F.min("started"))) / 1e6).alias("seconds"),
    )


def ring(df: DataFrame, capacity: int, keys: tuple[str, ...], *order: str) -> DataFrame:
    """What a buffer that drops its oldest entries holds in the end."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(o) for o in order]))
    return df.withColumn("_n", n).where(F.col("_n") <= capacity).drop("_n")


def admitted(df: DataFrame, capacity: int, policy: str, keys: tuple[str, ...], *order: str) -> DataFrame:
    """Entries of a full queue that stay: drop_oldest keeps the last ones, drop_newest and block the first."""
    if policy not in ("drop_oldest", "drop_newest", "block"):
        raise ValueError(f"no policy {policy}")
    if policy == "drop_oldest":
        return ring(df, capacity, keys, *order)
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_n", n).where(F.col("_n") <= capacity).drop("_n")


def notifications(alerts: DataFrame, channels: dict[str, list[str]]) -> DataFrame:
    """(channel, payload): each alert as JSON text for every channel that wants its severity."""
    wants = F.array_compact(F.array(*[F.when(F.col("severity").isin(*levels), F.lit(name)) for name, levels in channels.items()]))
    return alerts.select(F.explode(wants).alias("channel"), F.to_json(F.struct(*alerts.columns)).alias("payload"))
