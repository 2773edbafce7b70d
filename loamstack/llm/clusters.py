"""Centroid clustering of vectors in exact integers, by blocked matrix products.

Components become the integers floor(256 * x).  Vectors are packed into blocks, one row of a
stored table each, so that rounds move few and large rows.  A block's squared distances
to all centroids are |x|^2 - 2 x.c + |c|^2, one float64 matrix product: where no
magnitude that the sum can reach passes 2^53 every step of it is an exact integer.  Rows (or
centroids) beyond that bound are taken in 64-bit integers, and those beyond 2^63 in
Python's, so that every distance is exact at every size.  ``treeAggregate`` combines counts and
sums of the blocks; only centroids reach the driver.

Defined results: vectors that are null, of another length, or with a null or non-finite component take
no part; an empty table gives no rows; a row without id is clustered like any other and comes
last where starting centroids are chosen; repeated rows are as many vectors, and rows with
one hash are ordered by their components; fewer vectors than clusters give as many centroids
as vectors; distances and inertias beyond a long are null; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store

WIDTH = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
#: Centroids start as the vectors whose SHA-256 of this and their id is smallest.
SEED = "2:"
#: Integers up to here are exact in float64.
EXACT = 1 << 53
LONG = 1 << 63
#: Rows whose differences to all centroids are held at once where matrix products would not be exact.
WIDE_ROWS = 64

BLOCKS = "ids binary, known binary, wide boolean, body binary"


def usable(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(id, x: array of double) of the vectors that take part."""
    x = F.transform(vector, lambda v: v.cast("double"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vectors.select(F.col(key).cast("long").alias("id"), x.alias("x")).where((F.size("x") == WIDTH) & finite)


def scaled(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x): int64 where all fit, else Python's integers."""
    if not x.size or np.abs(x).max() < 2.0**40:
        return np.floor(x * SCALE).astype(np.int64)
    whole = lambda v: int(v) * SCALE if abs(v) >= 2.0**53 else int(np.floor(v * SCALE))  # noqa: E731  from 2^53 on a double is an integer
    return np.frompyfunc(whole, 1, 1)(x).astype(object)


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        if not len(rows):
            continue
        x = np.stack(rows["x"]).astype(np.float64)
        q = scaled(x)
        wide = q.dtype == object or np.abs(q).max() >= 1 << 31
        body = x.astype("<f8") if wide else q.astype("<i4")
        ids = rows["id"].fillna(0).astype("int64").to_numpy()
        yield pd.DataFrame({"ids": [ids.astype("<i8").tobytes()], "known": [rows["id"].notna().to_numpy().tobytes()], "wide": [wide], "body": [body.tobytes()]})


def components(wide: bool, body: bytes) -> np.ndarray:
    """A block's integer vectors."""
    if wide:
        return scaled(np.frombuffer(body, "<f8").reshape(-1, WIDTH))
    return np.frombuffer(body, "<i4").reshape(-1, WIDTH).astype(np.int64)


def _by_product(q: np.ndarray, centres: np.ndarray) -> np.ndarray:
    x, c = q.astype(np.float64), centres.astype(np.float64)
    return np.einsum("ij,ij->i", x, x)[:, None] - 2 * (x @ c.T) + np.einsum("ij,ij->i", c, c)


def _by_difference(q: np.ndarray, centres: np.ndarray) -> np.ndarray:
    parts = [((q[k : k + WIDE_ROWS, None, :] - centres[None]) ** 2).sum(axis=2) for k in range(0, len(q), WIDE_ROWS)]
    return np.concatenate(parts)


def nearest(q: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each vector's nearest centroid, exactly; of ties the smaller number."""
    far = int(np.abs(centres).max())
    reach = np.abs(q).max(axis=1)
    bound = lambda limit: np.array([WIDTH * (int(m) + far) ** 2 < limit for m in np.unique(reach)], bool)[np.searchsorted(np.unique(reach), reach)]
    number, distance = np.zeros(len(q), np.int64), np.zeros(len(q), object)
    exact, fits = bound(EXACT), bound(LONG)
    for rows, way, kind in ((exact, _by_product, np.int64), (fits & ~exact, _by_difference, np.int64), (~fits, _by_difference, object)):
        if rows.any():
            d = way(q[rows].astype(kind), centres.astype(kind))
            at = d.argmin(axis=1)
            number[rows] = at
            distance[rows] = d[np.arange(len(d)), at].astype(kind)
    return number, distance


def _add(total: dict, block, centres: np.ndarray) -> dict:
    """``total``, {cluster: [rows, sums, distance]} in Python's integers, with a block's vectors in it."""
    q = components(block["wide"], bytes(block["body"]))
    number, distance = nearest(q, centres)
    narrow = q.dtype != object and int(np.abs(q).max()) * len(q) < LONG
    for k in np.unique(number):
        rows = q[number == k]
        sums = rows.sum(axis=0) if narrow else rows.astype(object).sum(axis=0)
        found = [len(rows), [int(s) for s in sums], sum(int(d) for d in distance[number == k])]
        total[int(k)] = _merge_one(total.get(int(k)), found)
    return total


def _merge_one(a: list | None, b: list) -> list:
    return b if a is None else [a[0] + b[0], [x + y for x, y in zip(a[1], b[1])], a[2] + b[2]]


def _merge(a: dict, b: dict) -> dict:
    return a | {k: _merge_one(a.get(k), v) for k, v in b.items()}


def packed(vectors: DataFrame) -> DataFrame:
    """A stored table of blocks of the usable vectors."""
    return store.materialize(usable(vectors).mapInPandas(_pack, BLOCKS), "blocks")


def first_centres(vectors: DataFrame, clusters: int) -> np.ndarray:
    rows = usable(vectors).withColumn("hash", F.sha2(F.concat(F.lit(SEED), F.col("id").cast("string")), 256))
    rows = rows.orderBy(F.col("hash").asc_nulls_last(), "x").limit(clusters).select("x").collect()  # at most ``clusters`` vectors
    return scaled(np.array([r["x"] for r in rows], np.float64).reshape(-1, WIDTH))


def _narrowed(centres: list[list[int]]) -> np.ndarray:
    out = np.array(centres, dtype=object)
    return out.astype(np.int64) if max(abs(v) for c in centres for v in c) < LONG else out


def fit(blocks: DataFrame, centres: np.ndarray, rounds: int) -> tuple[np.ndarray, dict]:
    """The centroids after ``rounds``, and {cluster: [rows, sums, distance]} of the last assignment."""
    rdd = blocks.select("wide", "body").rdd

    def totals(at: np.ndarray) -> dict:
        return rdd.treeAggregate({}, lambda total, block: _add(total, block, at), _merge)

    for _ in range(rounds):
        found = totals(centres)
        moved = [[s // found[k][0] for s in found[k][1]] if k in found else [int(v) for v in c] for k, c in enumerate(centres)]
        centres = _narrowed(moved)
    return centres, totals(centres)


def _long(value: int) -> int | None:
    return int(value) if value < LONG else None


CLUSTERED = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def clustered(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS) -> DataFrame:
    """A row for each usable vector: its cluster, squared distance, both inertias and its centroid's digest."""
    blocks, centres = packed(vectors), first_centres(vectors, clusters)
    if not len(centres):
        return vectors.sparkSession.createDataFrame([], CLUSTERED)
    centres, last = fit(blocks, centres, rounds)
    inertia = {k: _long(v[2]) for k, v in last.items()}
    whole = _long(sum(v[2] for v in last.values()))
    digest = [hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest() for c in centres]

    def assigned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for ids, known, wide, body in zip(rows["ids"], rows["known"], rows["wide"], rows["body"]):
                number, distance = nearest(components(wide, body), centres)
                out = pd.DataFrame({"vec_id": pd.Series(np.frombuffer(ids, "<i8")).astype("Int64").where(np.frombuffer(known, bool), pd.NA), "cluster": number.astype(np.int32)})
                out["distance"] = pd.array([_long(d) for d in distance], dtype="Int64")
                out["cluster_inertia"] = pd.array([inertia[int(k)] for k in number], dtype="Int64")
                out["inertia"] = pd.array([whole] * len(out), dtype="Int64")
                out["centroid_sha256"] = [digest[int(k)] for k in number]
                yield out

    return blocks.mapInPandas(assigned, CLUSTERED)


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(store.table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    # All sums stay below 2^53 on the tables at hand, so that products of doubles are exact here as well.
    steps = [f"""
k AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings
  WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, x) - 1 AS n, q AS c FROM (SELECT sha256('{SEED}' || vec_id) AS h, x, q FROM k ORDER BY h NULLS LAST, x LIMIT {CLUSTERS}))"""]
    near = "SELECT vec_id, q, min({{'d': list_inner_product(q, q) - 2 * list_inner_product(q, c) + list_inner_product(c, c), 'n': n}}) AS m FROM (SELECT row_number() OVER () AS r, * FROM k), c{0} GROUP BY r, vec_id, q"
    for i in range(ROUNDS):
        steps.append(f"""
a{i} AS MATERIALIZED ({near.format(i)}),
s{i} AS (SELECT n, i, sum(v)::HUGEINT AS s, count(*)::HUGEINT AS w FROM (SELECT m.n AS n, unnest(range(1, {WIDTH} + 1)) AS i, unnest(q)::BIGINT AS v FROM a{i}) GROUP BY n, i),
m{i} AS (SELECT n, list(((s - ((s % w) + w) % w) // w)::DOUBLE ORDER BY i) AS c FROM s{i} GROUP BY n),
c{i + 1} AS MATERIALIZED (SELECT n, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (n))""")
    return f"""WITH {",".join(steps)},
last AS MATERIALIZED ({near.format(ROUNDS)})
SELECT vec_id, m.n::INT AS cluster, m.d::BIGINT AS distance, (sum(m.d::BIGINT) OVER (PARTITION BY m.n))::BIGINT AS cluster_inertia, (sum(m.d::BIGINT) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(list_transform(c, lambda v: v::BIGINT), ',')) AS centroid_sha256
FROM last JOIN c{ROUNDS} ON n = m.n"""


OP11_SQL = _sql()
