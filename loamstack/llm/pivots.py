"""Near-duplicate vectors by a pivot-permutation index.

Reference points, the pivots, are far-apart vectors of a bounded sample.  A vector is described by its nearest
pivots in order, and posted in inverted lists: one for each two of its first ``POSTED``
pivots, so that two vectors meet exactly if they have at least two of these in common.
Every vector is indexed; a list is never capped but cut into blocks, and each pair of blocks is
one matrix product.  A pair that meets in several lists is counted in that of its two
smallest common pivots alone, so counts are exact without listing pairs.

Copies are one vector with a count.  Vectors with one permutation whose angle to its first
vector is at most half the limit's are a ball: all its pairs are links, without looking at them.  Balls
and single vectors are posted alike; two that lie so that all or none of their
pairs are links are settled by their centres, the others are looked at vector by vector.  So a
large group of near copies costs as many rows as it has permutations.  Lists first carry 64-bit sketches
of signs only; whole vectors are sent to a list's blocks only where a sketch is near another.

Recall, against brute force in 64 dimensions with 256 pivots: pairs of a cosine of 0.93 exactly meet in 0.97 (vectors
about one centre) to 0.99 (without one) of cases, those of 0.95 in 0.995; the tests hold 0.9 from 0.931 on.

Defined results: vectors that are null, zero or have null or non-finite components, rows without label and
rows without id have no links (without an id the component is null and the row is kept); vectors of different
lengths have no link; repeated rows are as many vectors, linked with each other; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store
from .components import connected_components

COSINE = 0.93
#: Pivots of an ordered description, and the first of them under whose pairs a vector is posted.
ORDERED, POSTED = 8, 6
#: The sample that pivots are chosen from, and the most and fewest pivots.
SAMPLE, MOST_PIVOTS, LEAST_PIVOTS = 4096, 1024, 64
#: Pivots are no nearer to each other than the first of these cosines that leaves enough of them.
APART = (0.7, 0.8, 0.9, 0.999)
#: Units of a list in one block; a task holds two blocks.
BLOCK = 512
#: Signs of a sketch in which units that may be linked can differ (of 64; linked centres differ in 8 on average, balls in 16 at most on average).
SIGNS = 24
#: Allowed error of angles; what is nearer to a limit is looked at vector by vector.
MARGIN = 1e-6


def _unit(raw: pd.Series, kind: str) -> np.ndarray:
    """Unit vectors of one width from their bytes."""
    x = np.frombuffer(b"".join(raw), kind).astype(np.float64).reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


def _pack(kind: str):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            bodies, keys = [], []
            for key, label, v in zip(rows["id"], rows["label"], rows["v"]):
                x = None if v is None or pd.isna(key) or pd.isna(label) else np.array([np.nan if c is None else c for c in v], np.float64)
                usable = x is not None and len(x) and np.isfinite(x).all() and x.any()
                body = (x + 0.0).astype(kind).tobytes() if usable else None
                bodies.append(body)
                keys.append(xxhash.xxh3_128_digest(body) if usable else None)
            yield pd.DataFrame({"id": rows["id"].astype("Int64"), "label": rows["label"], "body": bodies, "key": keys})

    return pack


def choose_pivots(sample: list[bytes], kind: str, wanted: int) -> list[np.ndarray]:
    """At most ``wanted`` unit vectors of the sample, in its order, none near an earlier one."""
    units = [_unit(pd.Series([raw]), kind)[0] for raw in sample]
    chosen: list[np.ndarray] = []
    for limit in APART:
        chosen = []
        for u in units:
            if all(len(c) != len(u) or c @ u < limit for c in chosen):
                chosen.append(u)
            if len(chosen) == wanted:
                return chosen
        if len(chosen) * 2 >= wanted:
            break
    return chosen


def _describe(kind: str, pivots: list[np.ndarray]):
    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for _, same in rows.groupby(rows["body"].str.len(), sort=False):
                u = _unit(same["body"], kind)
                width = u.shape[1]
                points = np.zeros((len(pivots), width))
                for k, p in enumerate(pivots):
                    points[k, : min(width, len(p))] = p[:width]
                order = np.argsort(-(u @ points.T), axis=1, kind="stable")[:, :ORDERED].astype(np.int32)
                signs = u @ np.random.default_rng([width, 64]).standard_normal((width, 64)) >= 0
                sketch = np.packbits(signs, axis=1).view("<i8")[:, 0]
                yield same.drop(columns=["body"]).assign(body=same["body"], width=np.int32(width), pivots=list(order), sketch=sketch)[["node", "label", "width", "mult", "body", "pivots", "sketch"]]

    return describe


def _whole_runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Rows of whole keys and where each key's rows begin, of a partition sorted by keys."""
    held: list[pd.DataFrame] = []

    def begun(rows: pd.DataFrame) -> np.ndarray:
        x = rows[keys].to_numpy()
        return np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]).any(axis=1)]))

    for rows in batches:
        if not len(rows):
            continue
        held.append(rows)
        both = pd.concat(held, ignore_index=True)
        starts = begun(both)
        if starts[-1]:
            yield both.iloc[: starts[-1]], starts[:-1]
        held = [both.iloc[starts[-1] :]]
    if held:
        yield held[0].reset_index(drop=True), np.zeros(1, np.int64)


def _runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    for rows, starts in _whole_runs(batches, keys):
        for a, b in zip(starts, [*starts[1:], len(rows)]):
            yield rows.iloc[a:b]


LIST = ["label", "width", "p1", "p2"]
PAIR = [*LIST, "low", "high"]


def _in_blocks(posts: DataFrame, sizes: DataFrame) -> DataFrame:
    """Posts of lists with two units at least, each in all pairs of blocks that its block is in."""
    parts = F.ceil(F.col("units") / BLOCK).cast("int")
    live = posts.join(sizes.where("units > 1").select(*LIST, parts.alias("parts")), LIST)
    live = live.withColumn("part", F.pmod(F.xxhash64("unit"), "parts").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    live = live.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")}).drop("other", "parts")
    return live.repartition(*PAIR).sortWithinPartitions(*PAIR)


def _sides(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    part, low, high = rows["part"].to_numpy(), rows["low"].iloc[0], rows["high"].iloc[0]
    return np.flatnonzero(part == low), np.flatnonzero(part == high)


#: Lists of at most so many units are held against themselves many at once.
SHORT = 32


def _near_sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Posts whose sketch is near another's of the pair of blocks."""
    for rows, starts in _whole_runs(batches, PAIR):
        x, run = rows["sketch"].to_numpy().view(np.uint64), np.zeros(len(rows), np.int64)
        run[starts[1:]] = 1
        run, near, sizes = run.cumsum(), np.zeros(len(rows), bool), np.diff([*starts, len(rows)])
        short = (sizes <= SHORT) & (rows["low"].to_numpy() == rows["high"].to_numpy())[starts]
        for step in range(1, min(SHORT, int(sizes[short].max(initial=1)))):
            met = (run[step:] == run[:-step]) & short[run[step:]] & (np.bitwise_count(x[step:] ^ x[:-step]) <= SIGNS)
            near[step:] |= met
            near[:-step] |= met
        for k in np.flatnonzero(~short):
            own = slice(starts[k], starts[k] + sizes[k])
            a, b = _sides(rows.iloc[own])
            apart = np.bitwise_count(x[own][a][:, None] ^ x[own][b][None]) > SIGNS
            if rows["low"].iloc[starts[k]] == rows["high"].iloc[starts[k]]:
                np.fill_diagonal(apart, True)
            near[starts[k] + a] |= ~apart.all(axis=1)
            near[starts[k] + b] |= ~apart.all(axis=0)
        yield rows.loc[near, [*PAIR, "unit", "part"]]


def _forest(i: np.ndarray, j: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Few edges that join what the pairs (i, j) join."""
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[i], root[j])
        if (root[i] == low).all() and (root[j] == low).all():
            break
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        np.minimum.at(root, before[i], low)
        np.minimum.at(root, before[j], low)
        root = root[root]
    moved = np.flatnonzero(root != np.arange(len(names)))
    return names[moved], names[root[moved]]


FOUND = "kind int, a long, b long"
#: Links of all vectors of unit a, links of vector a, an edge, a pair of units to be looked at.
OF_UNIT, OF_NODE, EDGE, OPEN = 0, 1, 2, 3


def _found(kind: int, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"kind": np.full(len(a), kind, np.int32), "a": a.astype(np.int64), "b": b.astype(np.int64)})


def _linked(kind: int, i: np.ndarray, j: np.ndarray, names: np.ndarray, weights: np.ndarray) -> list[pd.DataFrame]:
    """Counts of links for each side of the linked pairs, and edges."""
    if not len(i):
        return []
    counts = np.zeros(len(names), np.int64)
    np.add.at(counts, i, weights[j])
    np.add.at(counts, j, weights[i])
    some = np.flatnonzero(counts)
    return [_found(kind, names[some], counts[some]), _found(EDGE, *_forest(i, j, names))]


def _first_list(p: np.ndarray, q: np.ndarray, one: int, two: int) -> np.ndarray:
    """Whether (one, two) are the smallest two common pivots of each pair of rows (sorted pivots)."""
    common = (p[:, :, None] == q[:, None, :]).any(axis=2)
    return ~(common & (p < two) & (p != one)).any(axis=1)


def _settle(kind: str, cosine: float):
    limit = math.acos(cosine)

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _runs(batches, PAIR):
            u, names, weights, radius = _unit(rows["body"], kind), rows["unit"].to_numpy(), rows["weight"].to_numpy(), rows["radius"].to_numpy()
            pivots = np.sort(np.stack(rows["posted"]), axis=1)
            a, b = _sides(rows)
            product = u[a] @ u[b].T
            angle, reach = _angle(product), radius[a][:, None] + radius[b][None]
            near = np.where(reach == 0, product >= cosine, angle <= limit + reach + MARGIN)
            if rows["low"].iloc[0] == rows["high"].iloc[0]:
                near = np.triu(near, 1)
            x, y = np.nonzero(near)
            first = _first_list(pivots[a[x]], pivots[b[y]], rows["p1"].iloc[0], rows["p2"].iloc[0])
            x, y = x[first], y[first]
            sure = (reach[x, y] == 0) | (angle[x, y] + reach[x, y] <= limit - MARGIN)
            yield from _linked(OF_UNIT, a[x[sure]], b[y[sure]], names, weights)
            if not sure.all():
                yield _found(OPEN, names[a[x[~sure]]], names[b[y[~sure]]])

    return settle


OPENED = ["a", "b", "pa", "pb"]


def _look(kind: str, cosine: float):
    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _runs(batches, OPENED):
            side, u = rows["right"].to_numpy(), _unit(rows["body"], kind)
            a, b = np.flatnonzero(~side), np.flatnonzero(side)
            if len(a) and len(b):
                x, y = np.nonzero(u[a] @ u[b].T >= cosine)
                yield from _linked(OF_NODE, a[x], b[y], rows["node"].to_numpy(), rows["mult"].to_numpy())

    return look


def _centre_angle(kind: str) -> Callable:
    @F.pandas_udf("double")
    def angle(body: pd.Series, centre: pd.Series) -> pd.Series:
        out = np.zeros(len(body))
        for _, at in pd.Series(np.arange(len(body))).groupby(body.str.len().to_numpy()):
            k = at.to_numpy()
            out[k] = _angle(np.einsum("ij,ij->i", _unit(body.iloc[k], kind), _unit(centre.iloc[k], kind)))
        return pd.Series(np.where((body == centre).to_numpy(), 0.0, out))

    return angle


def described(reps: DataFrame, kind: str) -> DataFrame:
    """A stored table of representatives with their ordered pivots and sketches."""
    count = reps.count()
    wanted = int(min(MOST_PIVOTS, max(LEAST_PIVOTS, 1 << round(math.log2(max(1, count)) / 2 + 0.5))))
    sample = [bytes(r["body"]) for r in reps.orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("body").collect()]  # at most SAMPLE vectors
    pivots = choose_pivots(sample, kind, wanted)
    return store.materialize(reps.select("node", "label", "mult", "body").mapInPandas(_describe(kind, pivots), "node long, label long, width int, mult long, body binary, pivots array<int>, sketch long"), "described")


def balls(points: DataFrame, kind: str, cosine: float) -> DataFrame:
    """``points`` with the unit that each is in (a ball's centre, or itself) and the angle to its centre."""
    whose = ["label", "width", "pivots"]
    centres = points.groupBy(*whose).agg(F.min_by(F.struct("node", "body"), "node").alias("c"))
    held = points.join(centres, whose).withColumn("angle", _centre_angle(kind)("body", F.col("c.body")))
    inside = F.col("angle") <= math.acos(cosine) / 2 - MARGIN
    held = held.withColumns({"unit": F.when(inside, F.col("c.node")).otherwise(F.col("node")), "angle": F.when(inside, F.col("angle")).otherwise(0.0)})
    return store.materialize(held.drop("c"), "balls")


def links(points: DataFrame, kind: str, cosine: float) -> tuple[DataFrame, DataFrame]:
    """(kind, a, links) with vectors of other units, and (a, b) that join nodes."""
    units = points.groupBy("unit").agg(F.max("angle").alias("radius"), F.sum("mult").alias("weight"), F.count("*").alias("members"))
    units = store.materialize(points.where("node = unit").drop("angle", "mult", "node").join(units, "unit").withColumn("posted", F.slice("pivots", 1, POSTED)).drop("pivots"), "units")
    order = F.array_sort("posted")
    places = list(itertools.combinations(range(POSTED), 2))
    twos = F.array(*[F.struct(F.get(order, F.lit(i)).alias("p1"), F.get(order, F.lit(j)).alias("p2")) for i, j in places])
    posts = units.select("unit", "label", "width", "sketch", F.explode(twos).alias("p")).where("p.p2 IS NOT NULL").select("unit", "label", "width", "sketch", "p.*")
    sizes = posts.groupBy(*LIST).agg(F.count("*").alias("units"))
    near = _in_blocks(posts, sizes).mapInPandas(_near_sketches, "label long, width int, p1 int, p2 int, low int, high int, unit long, part int")
    near = store.materialize(near, "near")
    sent = near.join(units.select("unit", "body", "radius", "weight", "posted"), "unit").repartition(*PAIR).sortWithinPartitions(*PAIR)
    found = store.materialize(sent.mapInPandas(_settle(kind, cosine), FOUND), "found")
    opened = _open(found, points, units, kind, cosine)
    both = found.where(F.col("kind") != OPEN).unionByName(opened)
    return both.where(F.col("kind") <= OF_NODE).groupBy("kind", "a").agg(F.sum("b").alias("links")), both.where(F.col("kind") == EDGE).select("a", "b")


def _open(found: DataFrame, points: DataFrame, units: DataFrame, kind: str, cosine: float) -> DataFrame:
    """Counts and edges of the pairs of units whose centres leave them open, by their vectors."""
    open_ = found.where(F.col("kind") == OPEN).select("a", "b")
    parts = units.select("unit", F.ceil(F.col("members") / BLOCK).cast("int").alias("parts"))
    pairs = open_.join(parts.toDF("a", "na"), "a").join(parts.toDF("b", "nb"), "b")
    members = points.select("unit", "node", "mult", "body")
    sides = []
    for right, (mine, other) in enumerate((("a", "b"), ("b", "a"))):
        rows = pairs.join(members.withColumnRenamed("unit", mine), mine).withColumn(f"p{mine}", F.pmod(F.xxhash64("node"), f"n{mine}").cast("int"))
        rows = rows.withColumn(f"p{other}", F.explode(F.sequence(F.lit(0), F.col(f"n{other}") - 1)))
        sides.append(rows.select(*OPENED, F.lit(bool(right)).alias("right"), "node", "mult", "body"))
    dealt = sides[0].unionByName(sides[1]).repartition(*OPENED).sortWithinPartitions(*OPENED)
    return store.materialize(dealt.mapInPandas(_look(kind, cosine), FOUND), "opened")


def similar_vectors(vectors: DataFrame, cosine: float = COSINE, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """A row for each vector: its id, n_links (others linked with it), component_id and kept."""
    kind = "<f4" if "array<float>" in dict(vectors.dtypes)[vector] else "<f8"
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v"))
    packed = store.materialize(rows.mapInPandas(_pack(kind), "id long, label long, body binary, key binary"), "packed")
    reps = packed.where("key IS NOT NULL").groupBy("label", "key").agg(F.min("id").alias("first"), F.count("*").alias("mult"), F.min("body").alias("body"))
    reps = store.materialize(reps.withColumn("node", F.monotonically_increasing_id()), "vectors")
    points = balls(described(reps, kind), kind, cosine)
    counts, edges = links(points, kind, cosine)
    counts = store.materialize(counts, "counts")
    edges = edges.unionByName(points.where("node <> unit").select(F.col("node").alias("a"), F.col("unit").alias("b")))
    labels = connected_components(edges)
    weight = points.groupBy("unit").agg(F.sum("mult").alias("weight"))
    of = {kind: counts.where(F.col("kind") == kind).select(F.col("a").alias(at), F.col("links").alias(name)) for kind, at, name in ((OF_UNIT, "unit", "of_unit"), (OF_NODE, "node", "of_node"))}
    each = points.select("node", "unit").join(weight, "unit").join(of[OF_UNIT], "unit", "left").join(of[OF_NODE], "node", "left")
    each = each.join(labels, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "weight", "of_unit", "of_node")
    return _result(packed, reps, each)


def _result(packed: DataFrame, reps: DataFrame, each: DataFrame) -> DataFrame:
    others = F.col("weight") - 1 + F.coalesce("of_unit", F.lit(0)) + F.coalesce("of_node", F.lit(0))
    known = store.materialize(each.select("node", "root", others.alias("n_links")).join(reps.select("node", "label", "key", "first"), "node"), "known")
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    known = known.join(least, "root").select("label", "key", "n_links", "component_id")
    out = packed.select("id", "label", "key").join(known, ["label", "key"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def op13_pivot_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(store.table(spark, sf_dir, "embeddings"))


OP13_SQL = f"""
WITH RECURSIVE k AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
e AS MATERIALIZED (SELECT a.r, a.vec_id, b.r AS s, b.vec_id AS w FROM k a JOIN k b ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v)) >= {COSINE}),
reach AS (SELECT vec_id, vec_id AS w FROM k UNION SELECT reach.vec_id, e.w FROM reach JOIN e ON e.vec_id = reach.w),
c AS (SELECT vec_id, min(w) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT vec_id, count(*) AS n_links FROM e GROUP BY vec_id)
SELECT m.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component_id, m.vec_id)::BIGINT AS component_id, coalesce(component_id, m.vec_id) = m.vec_id AS kept
FROM embeddings m LEFT JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""
