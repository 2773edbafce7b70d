"""How the driver's tables stand in for metrics, health checks, costs, samples and updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import table


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events")


def metrics(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select("event_id", "ts", F.col("event_type").alias("name"), "value", "user_id")


def checks(spark: SparkSession, d: str) -> DataFrame:
    """Each of 50 components is a remainder of the user; errors are unhealthy, sign-ups degraded."""
    status = F.when(F.col("event_type") == "error", "unhealthy").when(F.col("event_type") == "signup", "degraded").otherwise("healthy")
    return events(spark, d).select((F.col("user_id") % 50).alias("component"), "ts", "event_id", status.alias("status"), F.col("value").alias("latency_ms"))


CHECKS_SQL = """checks AS (SELECT user_id % 50 AS component, ts, event_id, CASE event_type WHEN 'error' THEN 'unhealthy' WHEN 'signup' THEN 'degraded' ELSE 'healthy' END AS status, value AS latency_ms FROM events)"""


def usage(spark: SparkSession, d: str) -> DataFrame:
    """Events as model calls: the type gives the model, the value the tokens."""
    model = F.when(F.col("event_type") == "click", "gpt-4o").when(F.col("event_type") == "view", "gpt-4o-mini-x").when(F.col("event_type") == "purchase", "gpt-4").when(F.col("event_type") == "error", "unknown-model").otherwise("claude-3-haiku-20240307")
    return events(spark, d).select(
        F.col("ts").alias("timestamp"), "event_id", model.alias("model"), F.floor("value").alias("input_tokens"), (F.floor("value") % 100).alias("output_tokens"), F.concat(F.lit("op"), (F.col("user_id") % 3).cast("string")).alias("operation")
    )


USAGE_SQL = """usage AS (SELECT ts AS timestamp, event_id, CASE event_type WHEN 'click' THEN 'gpt-4o' WHEN 'view' THEN 'gpt-4o-mini-x' WHEN 'purchase' THEN 'gpt-4' WHEN 'error' THEN 'unknown-model' ELSE 'claude-3-haiku-20240307' END AS model,
  floor(value)::BIGINT AS input_tokens, floor(value)::BIGINT % 100 AS output_tokens, 'op' || (user_id % 3)::VARCHAR AS operation FROM events)"""


def updates(spark: SparkSession, d: str) -> DataFrame:
    """Line items as client updates: ten clients, their quantities as weights."""
    t = table(spark, d, "lineitem")
    return t.groupBy((F.col("l_suppkey") % 10).alias("client_id"), F.col("l_returnflag").alias("param"), F.col("l_linenumber").alias("idx")).agg(F.round(F.avg("l_quantity"), 6).alias("weight"), F.count("*").alias("num_samples")).withColumn("round", F.lit(1))


UPDATES_SQL = """updates AS (SELECT l_suppkey % 10 AS client_id, l_returnflag AS param, l_linenumber AS idx, round(avg(l_quantity), 6) AS weight, count(*) AS num_samples, 1 AS round FROM lineitem GROUP BY ALL)"""
