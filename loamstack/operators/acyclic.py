"""Insertion of edges in order that refuses those which would close a cycle, for graphs of any size.

An edge is refused if the edges taken before it lead from its target to its source.  Three facts let
many edges be settled at once: a repeated edge fares like its first copy; an edge between two strong
components of all edges is on no cycle; and where the edges taken so far already lead from one end to the
other, either way, nothing that comes later can change the answer.

Strong components are therefore settled apart.  One of at most ``MOST_NODES`` nodes is folded in
chunks of its first ``CHUNK`` edges; the chunk leaves who reaches whom as rows of bits, against which
all other edges of the component are held by joins, and only those between nodes without an order go on.  A
larger component is cut at the middle of its open edges: what the first half decides, again by its own
components, stands when the second is judged.

Edges with a null end are left out, as are loops; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..rounds import drop, kept

#: Nodes of a component whose reach is held as bits in one task (8,192 rows of 1 KB).
MOST_NODES = 1 << 13
#: Edges of a component that one task folds.
CHUNK = 1 << 16


def _label(edges: DataFrame) -> DataFrame:
    """(node, label): the least node that leads to each node, itself included.

    A label's own label leads to the node too, so each round also jumps: with numbers in random order a path
    takes about as many rounds as the logarithm of its length.
    """
    ends = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    label = kept(ends.withColumn("label", F.col("node")), "labels")
    while True:
        came = edges.join(label.select(F.col("node").alias("u"), "label"), "u").groupBy(F.col("v").alias("node")).agg(F.min("label").alias("came"))
        step = label.join(came, "node", "left").select("node", "label", F.least("label", F.coalesce("came", "label")).alias("one"))
        own = label.select(F.col("node").alias("one"), F.col("label").alias("two"))
        after = kept(step.join(own, "one").select("node", F.least("one", "two").alias("new"), "label"), "labels")
        moved = not after.where("new < label").isEmpty()
        drop(label)
        label = after.select("node", F.col("new").alias("label"))
        label._round_path = after._round_path
        if not moved:
            return label


def strong_components(edges: DataFrame) -> DataFrame:
    """(node, component) of nodes that edges (u, v) lead from and back to; components are numbered.

    Each round gives every node the least one that leads to it; of the nodes with one label, those that
    lead back to it are its component, and the others go on among themselves.
    """
    lines = edges.select("u", "v").where("u <> v").distinct()
    names = lines.select(F.col("u").alias("node")).union(lines.select("v")).distinct().withColumn("hash", F.xxhash64("node"))
    names = kept(names.repartitionByRange("hash").sortWithinPartitions("hash").select("node", F.monotonically_increasing_id().alias("id")), "names")
    number = lambda df, end: df.join(names.select(F.col("node").alias(end), F.col("id").alias(f"{end}_id")), end)
    live, found = kept(number(number(lines, "u"), "v").select(F.col("u_id").alias("u"), F.col("v_id").alias("v")), "edges"), None
    while not live.isEmpty():
        label = _label(live)
        mine = lambda end: label.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label"))
        same = kept(live.join(mine("u"), "u").join(mine("v"), "v").where("u_label = v_label").select("u", "v", "u_label"), "edges")
        back = _label(same.select(F.col("v").alias("u"), F.col("u").alias("v")))
        here = kept(back.join(label.withColumnRenamed("label", "first"), "node").where("label = first").select("node", F.col("first").alias("component")), "component")
        found = here if found is None else found.unionByName(here)
        outside = lambda df, end: df.join(here.select(F.col("node").alias(end)), end, "left_anti")
        before, live = live, kept(outside(outside(same.select("u", "v"), "u"), "v"), "edges")
        drop(before, label, same, back)
    drop(live)
    none = names.select("id", F.col("id").alias("component")).limit(0)
    alone = none if found is None else found.withColumnRenamed("node", "id")
    return names.join(alone, "id").select("node", "component")


def _bits(rows: list[int], words: int) -> list[np.ndarray]:
    return [np.frombuffer(r.to_bytes(8 * words, "little"), "<i8") for r in rows]


def _fold(nodes: int, edges: pd.DataFrame, reach: pd.DataFrame) -> tuple[np.ndarray, list[int]]:
    """Which of the edges are taken, in order of place, and the nodes ahead of each node after them, as bits."""
    ahead = [0] * nodes
    for i, bits in zip(reach["i"], reach["ahead"]):
        ahead[i] = int.from_bytes(np.asarray(bits, "<i8").tobytes(), "little")
    behind = [0] * nodes
    for i, bits in enumerate(ahead):
        for j in _ones(bits):
            behind[j] |= 1 << i
    taken = np.zeros(len(edges), bool)
    for k, (a, b) in enumerate(zip(edges["i"].tolist(), edges["j"].tolist())):
        if ahead[b] >> a & 1:
            continue
        taken[k] = True
        if ahead[a] >> b & 1:
            continue
        down, up = ahead[b] | 1 << b, behind[a] | 1 << a
        for x in _ones(up & ~behind[b]):
            ahead[x] |= down
        for x in _ones(down):
            behind[x] |= up
    return taken, ahead


def _ones(bits: int) -> Iterator[int]:
    raw = np.frombuffer(bits.to_bytes((bits.bit_length() + 7) // 8, "little"), np.uint8)
    return iter(np.flatnonzero(np.unpackbits(raw, bitorder="little")).tolist())


def _has(bits: str, j: str) -> Column:
    return F.getbit(F.element_at(bits, (F.floor(F.col(j) / 64) + 1).cast("int")), (F.col(j) % 64).cast("int")) == 1


def _small(edges: DataFrame, chunk: int) -> DataFrame:
    """Places of the edges (component, place, u, v) that are taken, of components with few nodes each."""
    ends = edges.select("component", F.col("u").alias("node")).union(edges.select("component", "v")).distinct()
    of = Window.partitionBy("component")  # at most MOST_NODES rows
    numbered = ends.select("component", "node", (F.row_number().over(of.orderBy("node")) - 1).cast("int").alias("i"), F.count("*").over(of).cast("int").alias("nodes"))
    nodes = kept(numbered, "nodes")
    end = lambda name, i: nodes.select("component", F.col("node").alias(name), F.col("i").alias(i))
    live = kept(edges.join(nodes.withColumnRenamed("node", "u"), ["component", "u"]).join(end("v", "j"), ["component", "v"]).select("component", "place", "i", "j", "nodes"), "edges")
    drop(nodes)
    component, out = dict(edges.dtypes)["component"], None
    reach = edges.sparkSession.createDataFrame([], f"component {component}, i int, ahead array<long>")

    def run(key, rows: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame({"component": [], "place": [], "i": [], "ahead": []})
        rows, n = rows.sort_values("place", ignore_index=True), int(rows["nodes"].iloc[0])
        taken, ahead = _fold(n, rows, before)
        places = rows["place"][taken]
        told = pd.DataFrame({"component": rows["component"].iloc[0], "place": places, "i": -1, "ahead": [None] * len(places)})
        bits = pd.DataFrame({"component": rows["component"].iloc[0], "place": -1, "i": np.arange(n), "ahead": _bits(ahead, -(-n // 64))})
        return pd.concat([told, bits], ignore_index=True)

    while not live.isEmpty():
        upto = _upto(live, chunk)
        marked = live.join(upto, "component")
        first = marked.where("place <= upto").drop("upto")
        done = kept(first.groupBy("component").cogroup(reach.groupBy("component")).applyInPandas(run, f"component {component}, place long, i int, ahead array<long>"), "folded")
        taken = done.where("i < 0").select("place")
        out = taken if out is None else out.unionByName(taken)
        reach = done.where("i >= 0").select("component", "i", "ahead")
        rest = kept(marked.where("place > upto").drop("upto"), "edges")
        drop(live)
        live = rest
        if rest.isEmpty():
            break
        held = rest.join(reach, ["component", "i"]).withColumn("along", _has("ahead", "j")).drop("ahead")
        held = held.join(reach.select("component", F.col("i").alias("j"), "ahead"), ["component", "j"]).withColumn("against", _has("ahead", "i")).drop("ahead")
        held = kept(held, "held")
        out = out.unionByName(held.where("along").select("place"))
        live = kept(held.where("NOT along AND NOT against").drop("along", "against"), "edges")
        drop(rest)
    drop(live)
    return out if out is not None else edges.select("place").limit(0)


def _upto(live: DataFrame, chunk: int) -> DataFrame:
    """(component, upto): the place up to which about ``chunk`` edges of each component lie, or all."""
    grid = F.array(*[F.lit(k / 1024) for k in range(1, 1024)])
    sizes = live.groupBy("component").agg(F.count("*").alias("n"), F.max("place").alias("last"), F.percentile_approx("place", grid, 10000).alias("grid"))
    at = F.greatest(F.lit(1), F.least(F.lit(1023), F.floor(F.lit(1024) * chunk / F.col("n"))))
    return sizes.select("component", F.when(F.col("n") <= chunk, F.col("last")).otherwise(F.element_at("grid", at.cast("int"))).alias("upto"))


def _settled(edges: DataFrame, most_nodes: int, chunk: int) -> DataFrame:
    """Places of the open edges of (place, u, v, open) that are taken; the others have been taken before."""
    if edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct().limit(most_nodes + 1).count() <= most_nodes:
        whole = kept(_small(edges.withColumn("component", F.lit(0)), chunk), "taken")
        return whole.join(edges.where("open").select("place"), "place", "left_semi")
    component = strong_components(edges)
    mine = lambda end: component.select(F.col("node").alias(end), F.col("component").alias(f"{end}_component"))
    told = kept(edges.join(mine("u"), "u", "left").join(mine("v"), "v", "left").withColumn("inner", F.coalesce(F.col("u_component") == F.col("v_component"), F.lit(False))), "told")
    out = told.where("open AND NOT inner").select("place")
    inner = told.where("inner").select("place", "u", "v", "open", F.col("u_component").alias("component"))
    nodes = component.groupBy("component").agg(F.count("*").alias("nodes"))
    inner = kept(inner.join(nodes, "component"), "inner")
    few = _small(inner.where(F.col("nodes") <= most_nodes).drop("nodes"), chunk)
    out = kept(out.unionByName(few.join(inner.where("open").select("place"), "place", "left_semi")), "taken")
    large = inner.where(F.col("nodes") > most_nodes)
    opens = large.where("open").groupBy("component").agg(F.count("*").alias("opens"), F.max("place").alias("last"), F.percentile_approx("place", 0.5, 10000).alias("middle"))
    # the edges taken before have no cycle, so a single open edge that is on one is refused
    large = kept(large.join(opens.where("opens > 1"), "component").withColumn("early", F.col("place") <= F.least("middle", F.col("last") - 1)), "large")
    if large.isEmpty():
        return out
    names = ["place", "u", "v", "open"]
    taken = _settled(large.where("early OR NOT open").select(names), most_nodes, chunk)
    out = out.unionByName(taken)
    before = large.where("NOT open").select(names).unionByName(large.where("open AND early").join(taken, "place", "left_semi").select(names).withColumn("open", F.lit(False)))
    late = kept(before.unionByName(large.where("open AND NOT early").select(names)), "late")
    return out.unionByName(_settled(late, most_nodes, chunk))


def acyclic(edges: DataFrame, *order: Column | str, source: str = "source", target: str = "target", most_nodes: int = MOST_NODES, chunk: int = CHUNK) -> DataFrame:
    """The rows of ``edges`` in ascending order, ties by source and target, without those that would close a cycle."""
    rank = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"_{k}") for k, c in enumerate([*order, source, target])])
    first = edges.where(F.col(source) != F.col(target)).groupBy(F.col(source).alias("u"), F.col(target).alias("v")).agg(F.min(rank).alias("rank"))
    first = kept(first, "firsts")
    sorted_ = kept(first.repartitionByRange("rank").sortWithinPartitions("rank").select("u", "v", F.monotonically_increasing_id().alias("place")), "places")
    taken = _settled(sorted_.withColumn("open", F.lit(True)), most_nodes, chunk)
    pairs = kept(sorted_.join(taken, "place", "left_semi").select(F.col("u").alias(source), F.col("v").alias(target)), "pairs")
    drop(first)
    return edges.join(pairs, [source, target], "left_semi").select(edges.columns)
