"""Causal graphs: closure, order, separation, discovery, scores and simulation."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import unit_interval
from ..rounds import drop
from ..rounds import kept as _round
from .acyclic import acyclic  # noqa: F401


def closure(edges: DataFrame) -> DataFrame:
    """(source, target, hops) of all nodes that reach another, with the fewest hops.

    Each round joins the newest pairs with the edges and keeps those not known, so cycles end.
    """
    edge = edges.select("source", "target").where("source <> target").distinct()
    known = new = _round(edge.withColumn("hops", F.lit(1)), "pairs")
    hops = 1
    while not new.isEmpty():
        hops += 1
        step = new.select("source", F.col("target").alias("via")).join(edge.select(F.col("source").alias("via"), "target"), "via").where("source <> target").select("source", "target").distinct()
        new = _round(step.join(known, ["source", "target"], "left_anti").withColumn("hops", F.lit(hops)), "pairs")
        known = known.unionByName(new)
    return known


def ancestors(edges: DataFrame, node) -> DataFrame:
    return closure(edges).where(F.col("target") == node).select(F.col("source").alias("node"))


def descendants(edges: DataFrame, node) -> DataFrame:
    return closure(edges).where(F.col("source") == node).select(F.col("target").alias("node"))


def topological(edges: DataFrame) -> DataFrame:
    """(node, depth): the longest path that leads to each node of an acyclic graph."""
    edge = edges.select("source", "target").distinct()
    level = _round(edge.select(F.col("source").alias("node")).union(edge.select("target")).distinct().withColumn("depth", F.lit(0)), "levels")
    nodes = level.count()
    for _ in range(nodes):
        up = edge.join(level.withColumnRenamed("node", "source"), "source").groupBy(F.col("target").alias("node")).agg((F.max("depth") + 1).alias("new"))
        nxt = _round(level.join(up, "node", "left").select("node", F.greatest("depth", F.coalesce("new", F.lit(0))).alias("depth")), "levels")
        if nxt.exceptAll(level).isEmpty():
            drop(level)
            return nxt
        drop(level)
        level = nxt
    raise ValueError("the graph has a cycle")


def separated(edges: DataFrame, x, y, given: list) -> bool:
    """Whether every directed path between x and y has a node of ``given`` inside."""
    inner = edges.where(~F.col("source").isin(*given) & ~F.col("target").isin(*given)) if given else edges
    return closure(inner).where(((F.col("source") == x) & (F.col("target") == y)) | ((F.col("source") == y) & (F.col("target") == x))).isEmpty()


def separations(edges: DataFrame, pairs: DataFrame, given: list) -> DataFrame:
    """``pairs`` (x, y) with ``separated``: whether every directed path between the two has a node of ``given`` inside.

    Pairs with a null are separated; repeated pairs are told each time.
    """
    inner = edges.where(~F.col("source").isin(*given) & ~F.col("target").isin(*given)) if given else edges
    low, high = F.least("source", "target"), F.greatest("source", "target")
    reach = closure(inner).select(low.alias("_low"), high.alias("_high"), F.lit(True).alias("_met")).distinct()
    told = pairs.withColumns({"_low": F.least("x", "y"), "_high": F.greatest("x", "y")}).join(reach, ["_low", "_high"], "left")
    return told.withColumn("separated", F.col("_met").isNull()).drop("_low", "_high", "_met")


def correlations(samples: DataFrame, variables: list[str]) -> DataFrame:
    """(a, b, r, n) of all pairs of columns, in one pass."""
    pairs = [(a, b) for i, a in enumerate(variables) for b in variables[i + 1 :]]
    row = samples.agg(F.count("*").alias("n"), *[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    found = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs])
    return row.select("n", F.explode(found).alias("x")).select("x.*", "n")


def discovered(samples: DataFrame, variables: list[str], critical_t: float = 1.959963985) -> DataFrame:
    """Edges in the order of the variables between those whose correlation is not by chance."""
    c = correlations(samples, variables)
    t = F.abs("r") * F.sqrt((F.col("n") - 2) / F.greatest(F.lit(1e-12), 1 - F.col("r") * F.col("r")))
    return c.where(t > critical_t).select(F.col("a").alias("source"), F.col("b").alias("target"), F.col("r").alias("strength"), F.least(F.lit(1.0), t / 10).alias("confidence"))


def edge_scores(true: DataFrame, found: DataFrame) -> DataFrame:
    """Precision, recall, F1 and structural distance of edge sets."""
    a = true.select("source", "target").distinct().withColumn("t", F.lit(True))
    b = found.select("source", "target").distinct().withColumn("f", F.lit(True))
    both, only_true, only_found = F.count_if(F.col("t") & F.col("f")), F.count_if(F.col("f").isNull()), F.count_if(F.col("t").isNull())
    row = a.join(b, ["source", "target"], "full").agg(both.alias("hit"), only_true.alias("missed"), only_found.alias("extra"))
    p, r = F.coalesce(F.try_divide("hit", F.col("hit") + F.col("extra")), F.lit(0.0)), F.coalesce(F.try_divide("hit", F.col("hit") + F.col("missed")), F.lit(0.0))
    return row.select(p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"), (F.col("missed") + F.col("extra")).alias("distance"))


def gaussian(key: Column, seed: int) -> Column:
    """A standard normal number that the key and the seed decide, by Box and Muller's way."""
    u, v = unit_interval(key, F.lit("u"), seed=seed), unit_interval(key, F.lit("v"), seed=seed)
    return F.sqrt(-2 * F.log(1 - u)) * F.cos(2 * math.pi * v)


def simulated(spark: SparkSession, order: list[str], parents: dict[str, list[str]], n: int, mechanisms: dict[str, Callable[[dict[str, Column], Column], Column]] | None = None, interventions: dict[str, float] | None = None, noise: float = 1.0, seed: int = 0) -> DataFrame:
    """n samples of a structural model in topological order; by default the mean of the parents plus noise."""
    rows = spark.range(n)
    for k, name in enumerate(order):
        eps = gaussian(F.col("id"), seed + k) * noise
        known = {p: F.col(p) for p in parents.get(name, [])}
        if interventions and name in interventions:
            value = F.lit(float(interventions[name]))
        elif mechanisms and name in mechanisms:
            value = mechanisms[name](known, eps)
        else:
            value = (sum(known.values(), F.lit(0.0)) / len(known) if known else F.lit(0.0)) + eps
        rows = rows.withColumn(name, value)
    return rows


def critical_t(p: float = 0.05) -> float:
    """Two-tailed critical value of the normal approximation, by bisection."""
    low, high = 0.0, 10.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - math.erf(mid / math.sqrt(2)) > p else (low, mid)
    return low
