"""An index for similar vectors: random hyperplanes in several tables, and exact confirmation.

A table gives each vector the signs of its products with ``bits`` random directions; vectors at an angle t agree in
one table with probability (1 - t / pi) ** bits.  ``plan`` chooses bits by the number of vectors, and then as many
tables as the wanted recall needs at the threshold.  Every vector is in every table; buckets are cut into
blocks, never capped, and a pair is told by the first table in which it agrees, so no distinct is needed.
Directions come from a seed and depend on nothing in the data.

Tables hold sketches: a byte a component, with the distance from what it stands for, so that no pair from the
threshold on is passed over.  A vector itself is sent only to those blocks where its sketch has a partner.  From 4,096
vectors to 2,097,152 of them (``BUCKET`` and ``FULL`` in each of 256 buckets) bits and tables stay as they are, so that
what is shuffled grows with the vectors; beyond, there is a bit more for each doubling, with the tables that it needs.

``dedup.similar_pairs`` is the exact way beside it, whose work grows with the square of the vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..rounds import kept

#: Rows that a bucket of unrelated vectors has on average, up to FLAT_BITS at least and beyond them at most; rows of one block, and the most bits and tables.
BUCKET, FLAT_BITS, FULL, BLOCK, MOST_BITS, MOST_TABLES = 16, 8, 8192, 32_768, 30, 200
#: Products that are held at once, and rows of one side; pairs that one place confirms, about.
PRODUCTS, ROWS, PAIRS = 1 << 20, 256, 1 << 18
SEED = 20240901


def plan(vectors: int, cosine: float, recall: float = 0.95) -> tuple[int, int]:
    """(bits, tables) for so many vectors; fewer bits where the threshold is so low that tables would be too many."""
    agree = 1 - math.acos(cosine) / math.pi
    wanted = min(round(math.log2(max(2, vectors / BUCKET))), max(FLAT_BITS, math.ceil(math.log2(max(1, vectors / FULL)))))
    for bits in range(min(MOST_BITS, max(1, wanted)), 0, -1):
        p = agree**bits
        tables = 1 if p >= recall else math.ceil(math.log(1 - recall) / math.log(1 - p))
        if tables <= MOST_TABLES:
            break
    return bits, tables


def _codes(u: np.ndarray, bits: int, tables: int) -> np.ndarray:
    directions = np.random.default_rng([SEED, u.shape[1], bits]).standard_normal((tables, bits, u.shape[1]))
    weights = 1 << np.arange(bits, dtype=np.int64)
    return np.stack([((u @ d.T) >= 0) @ weights for d in directions], axis=1)


def _units(bodies: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(bodies), "<f8").reshape(len(bodies), -1)


def _sketch(width: int, bits: int, tables: int) -> np.dtype:
    return np.dtype([("step", "<f4"), ("off", "<f4"), ("parts", "i1", (width,)), ("codes", _code(bits), (tables,))])


def _code(bits: int) -> str:
    return "<u1" if bits <= 8 else "<u2" if bits <= 16 else "<u4"


def _sketches(u: np.ndarray, codes: np.ndarray, bits: int) -> np.ndarray:
    out = np.empty(len(u), _sketch(u.shape[1], bits, codes.shape[1]))
    out["step"] = np.abs(u).max(axis=1) / 127
    step = out["step"].astype(np.float64)[:, None]
    out["parts"] = np.clip(np.rint(u / step), -127, 127)
    out["off"] = np.sqrt(((u - out["parts"] * step) ** 2).sum(axis=1))
    out["codes"] = codes
    return out


def units(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, width, body, row): unit vectors as bytes, and a number for each once they are written; null and zero vectors and those with null or non-finite components are left out."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            ids, widths, bodies = [], [], []
            for name, v in zip(rows["id"], rows["v"]):
                x = np.asarray(v, np.float64)  # null as nan
                top = np.abs(x).max() if len(x) else 0
                if np.isfinite(top) and top > 0:
                    x = x / top
                    ids.append(name)
                    widths.append(len(x))
                    bodies.append((x / np.sqrt(x @ x)).tobytes())
            yield pd.DataFrame({"id": ids, "width": np.array(widths, np.int32), "body": bodies})

    kind = dict(vectors.dtypes)[key]
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    return rows.mapInPandas(pack, f"id {kind}, width int, body binary").withColumn("row", F.monotonically_increasing_id())


def posted(units: DataFrame, bits: int, tables: int) -> DataFrame:
    """(table, width, code, row, sketch): a row for each vector and table."""

    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for width, same in rows.groupby("width"):
                u = _units(same["body"])
                codes = _codes(u, bits, tables)
                sketches = _sketches(u, codes, bits)
                raw, n = sketches.tobytes(), sketches.itemsize
                bodies = [raw[k : k + n] for k in range(0, len(raw), n)]
                for t in range(tables):
                    yield pd.DataFrame({"table": np.full(len(same), t, np.int32), "width": np.full(len(same), width, np.int32), "code": codes[:, t], "row": same["row"].to_numpy(), "sketch": bodies})

    return units.select("width", "body", "row").mapInPandas(post, "table int, width int, code long, row long, sketch binary")


BUCKETS = ["table", "width", "code"]


def counted(units: DataFrame, bits: int, tables: int) -> DataFrame:
    """(table, width, code, n): how many vectors each bucket has."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for width, same in rows.groupby("width"):
                codes = _codes(_units(same["body"]), bits, tables)
                for t in range(tables):
                    code, n = np.unique(codes[:, t], return_counts=True)
                    yield pd.DataFrame({"table": np.full(len(n), t, np.int32), "width": np.full(len(n), width, np.int32), "code": code, "n": n})

    return units.select("width", "body").mapInPandas(count, "table int, width int, code long, n long").groupBy(*BUCKETS).agg(F.sum("n").alias("n"))


def similar_pairs(vectors: DataFrame, cosine: float, key: str = "vec_id", vector: str = "embedding", recall: float = 0.95, bits_tables: tuple[int, int] | None = None) -> DataFrame:
    """(a, b, cosine), a < b: pairs from the threshold on, of which ``recall`` are found at the threshold itself and more above it."""
    rows = kept(units(vectors, key, vector), "units")
    bits, tables = bits_tables or plan(rows.count(), cosine, recall)
    large = counted(rows, bits, tables).where(F.col("n") > BLOCK).select(*BUCKETS, F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))  # at most vectors * tables / BLOCK rows
    dealt = posted(rows, bits, tables).join(F.broadcast(large), BUCKETS, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("row"), "parts").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select(*BUCKETS, "row", "sketch", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))
    places = [*BUCKETS, "low", "high"]
    kind = dict(rows.dtypes)["id"]

    def sides(place: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, bool]:
        left, right = (place["part"] == place["low"]).to_numpy(), (place["part"] == place["high"]).to_numpy()
        same = place["low"].iloc[0] == place["high"].iloc[0]
        if "cut" in place:
            left, right = left & (place["cut"] == place["first"]).to_numpy(), right & (place["cut"] == place["second"]).to_numpy()
            same = same and place["first"].iloc[0] == place["second"].iloc[0]
        return np.flatnonzero(left), np.flatnonzero(right), same

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The rows that have a partner in a place, as far as sketches tell; places of very many pairs are cut into ``first`` and ``second``."""
        for place in _buckets(batches, places):
            if len(place) < 2:
                continue
            table, width = int(place["table"].iloc[0]), int(place["width"].iloc[0])
            s = np.frombuffer(b"".join(place["sketch"]), _sketch(width, bits, tables))
            x, codes, off = s["parts"] * s["step"][:, None], s["codes"], float(s["off"].max())
            left, right, same = sides(place)
            found, pairs = np.zeros(len(place), bool), 0
            least = cosine - off * (2 + off) - 2e-7 * (width + 10)  # the last for rounding in 32 bits
            for i, j, _ in _products(x[left], x[right], least, same, codes[left, :table], codes[right, :table]):
                found[left[i]] = found[right[j]] = True
                pairs += len(i)
            if not pairs:
                continue
            cuts = math.ceil(math.sqrt(pairs / PAIRS))
            chosen = place.loc[found, [*places, "part", "row"]].assign(codes=[c.tobytes() for c in codes[found]])
            chosen["cut"] = cut = (chosen["row"] % cuts).astype(np.int32)
            ahead = (chosen["part"] == chosen["low"]).to_numpy()
            for other in range(cuts):
                first, second = (np.minimum(cut, other), np.maximum(cut, other)) if same else (np.where(ahead, cut, other), np.where(ahead, other, cut))
                yield chosen.assign(first=first, second=second)

    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for place in _buckets(batches, cut_places):
            u, ids, table = _units(place["body"]), place["id"].to_numpy(), int(place["table"].iloc[0])
            codes = np.frombuffer(b"".join(place["codes"]), _code(bits)).reshape(len(place), tables)
            left, right, same = sides(place)
            for i, j, product in _products(u[left], u[right], cosine, same, codes[left, :table], codes[right, :table]):
                x, y = ids[left[i]], ids[right[j]]
                yield pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y), "cosine": product})

    cut_places = [*places, "first", "second"]
    columns = "table int, width int, code long, low int, high int, part int, row long"
    chosen = dealt.repartition(*places).sortWithinPartitions(*places).mapInPandas(choose, f"{columns}, codes binary, cut int, first int, second int")
    sent = chosen.join(rows.select("row", "id", "body"), "row")
    return sent.repartition(*cut_places).sortWithinPartitions(*cut_places).mapInPandas(confirm, f"a {kind}, b {kind}, cosine double").where("a < b")


def _products(x: np.ndarray, y: np.ndarray, least: float, same: bool, codes_x: np.ndarray, codes_y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places in x and in y, and products, of pairs from ``least`` on that no earlier table tells; x in slices, and each pair once where y is the same."""
    step = max(1, min(ROWS, PRODUCTS // max(1, len(y))))
    for k in range(0, len(x), step):
        start = k if same else 0
        product = x[k : k + step] @ y[start:].T
        i, j = np.divmod(np.flatnonzero(product >= least), product.shape[1])
        if same:
            i, j = i[j > i], j[j > i]
        for t in range(codes_x.shape[1]):
            if not len(i):
                break
            fresh = codes_x[k + i, t] != codes_y[start + j, t]
            i, j = i[fresh], j[fresh]
        if len(i):
            yield k + i, start + j, product[i, j]


def _buckets(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of each key, of a partition sorted by keys."""
    held: pd.DataFrame | None = None
    for rows in batches:
        if not len(rows):
            continue
        rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
        x = rows[keys].to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]).any(axis=1)]))
        for a, b in zip(starts, starts[1:]):
            yield rows.iloc[a:b]
        held = rows.iloc[starts[-1] :]
    if held is not None:
        yield held


def compared(vectors: int, sizes: list[int]) -> float:
    """The share of all pairs that buckets of these sizes hold against each other."""
    return sum(n * (n - 1) for n in sizes) / max(1, vectors * (vectors - 1))
