"""Connected components by contraction, without a group's edges in one task.

Each level points every node to the least of itself and its neighbours, replaces edges by
those between what their ends point to, and drops loops; levels halve at least the
longest chain, and stars (the common case) end after one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (a, b: long); root is the least node reachable."""
    labels = None
    edges = store.materialize(edges.select("a", "b").where("a <> b"), "edges")
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        level = store.materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("to")), "level")
        labels = level if labels is None else store.materialize(
            labels.select("node", F.col("to").alias("via")).join(level.withColumnRenamed("node", "via"), "via", "left").select("node", F.coalesce("to", "via").alias("to")), "labels"
        )
        ends = edges.join(level.select(F.col("node").alias("a"), F.col("to").alias("pa")), "a").join(level.select(F.col("node").alias("b"), F.col("to").alias("pb")), "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))
        hops = level.select(F.col("to").alias("a")).distinct().join(level.select(F.col("node").alias("a"), F.col("to").alias("b")), "a")
        left = ends.unionByName(hops).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        done, edges = edges, store.materialize(left, "edges")
        store.drop(done)
        if edges.isEmpty():
            return labels.select("node", F.col("to").alias("root"))
