"""Pricing joins, cost reports and budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scores import token_cost

#: Prices in dollars per 1000 tokens in and out, in the order in which names are tried.
PRICES = [
    ("gpt-4o", 0.0025, 0.01), ("gpt-4o-mini", 0.00015, 0.0006), ("gpt-4-turbo", 0.01, 0.03), ("gpt-4", 0.03, 0.06), ("gpt-3.5-turbo", 0.0005, 0.0015),
    ("claude-3-opus-20240229", 0.015, 0.075), ("claude-3-5-sonnet-20241022", 0.003, 0.015), ("claude-3-haiku-20240307", 0.00025, 0.00125),
]


def price_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(m, i, o, k) for k, (m, i, o) in enumerate(PRICES)], "model_id string, price_in double, price_out double, ord int")


def priced(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Exact name, else the first price whose name holds or is held by the model's; names are resolved once each."""
    names = usage.select("model").distinct()
    hits = names.join(F.broadcast(prices), F.col("model").contains(F.col("model_id")) | F.col("model_id").contains(F.col("model")), "left")  # the price list is a configuration
    found = hits.groupBy("model").agg(F.min_by(F.struct("model_id", "price_in", "price_out"), F.struct(F.col("model") != F.col("model_id"), "ord")).alias("p")).select("model", "p.*")
    rows = usage.join(found, "model", "left")
    return rows.withColumn("cost", token_cost(F.col("input_tokens"), F.col("output_tokens"), F.col("price_in"), F.col("price_out")))


def report(costs: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Totals, by model and by operation, in one pass; both ends of the time range count."""
    if start is not None:
        costs = costs.where(F.col("timestamp") >= start)
    if end is not None:
        costs = costs.where(F.col("timestamp") <= end)
    return costs.groupingSets([["model"], ["operation"], []], "model", "operation").agg(F.count("*").alias("requests"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.sum("cost").alias("cost"))


def budget(costs: DataFrame, total: float) -> DataFrame:
    spent = F.coalesce(F.sum("cost"), F.lit(0.0))
    return costs.agg(spent.alias("spent"), F.greatest(F.lit(0.0), F.lit(total) - spent).alias("remaining"), (spent / total * 100).alias("used_percent"), (spent >= total).alias("over"))


def running_budget(costs: DataFrame, total: float, key: str, *order: str) -> DataFrame:
    """Spending of each key so far, and whether it is still within the budget."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return costs.withColumn("spent", F.sum("cost").over(w)).withColumn("within", F.col("spent") <= total)


def service_costs(states: DataFrame, service: str = "service", fields: str = "fields") -> DataFrame:
    """Sum of the numeric entries whose name has ``cost``, of each service's state map."""
    entries = states.select(service, F.explode(fields).alias("name", "raw")).where(F.lower("name").contains("cost"))
    return entries.groupBy(service).agg(F.sum(F.col("raw").try_cast("double")).alias("cost"))
