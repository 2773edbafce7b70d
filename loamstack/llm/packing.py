"""Best-fit packing of documents into fixed-length sequences by a grouping genetic
algorithm on islands.

Documents are encoded and cut at the sequence length.  Full pieces are sequences of
their own; the others are dealt at random into groups of a bounded size.  Each
group is packed by several islands, each a population of packings that starts from documents
in random orders: crossover injects whole well-filled bins of one parent into the other, bins
that share a document with them are dissolved, and the displaced documents are placed by best
fit.  After an epoch each island's elite moves to the next island of its group; the best
packing of the last epoch wins.  An island rests once it has as few bins as its tokens can
take; ``evolution`` tells how many generations each group took and what they saved.  Documents in bins that are left badly filled are pooled, dealt
anew and packed once more, so few bins are lost to the cutting into groups.

Defined results: a null or empty text is the end id alone; repeated rows are packed
each; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store
from .tokens import encoder

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
LENGTH = 4096
#: Documents packed together; a group's size does not grow with the input.
GROUP = 2048
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 8
POPULATION = 4
#: Bins filled less than this are dissolved and packed in the pooled round.
WELL_FILLED = 0.995


# --- one group -----------------------------------------------------------------------


class Bins:
    """Residual room of bins, ordered for best fit."""

    def __init__(self, room: list[tuple[int, int]], capacity: int, next_id: int):
        self.room, self.capacity, self.next_id = sorted(room), capacity, next_id

    def place(self, length: int) -> int:
        at = bisect_left(self.room, (length, -1))
        if at < len(self.room):
            left, name = self.room.pop(at)
        else:
            left, name, self.next_id = self.capacity, self.next_id, self.next_id + 1
        if left > length:
            insort(self.room, (left - length, name))
        return name


def best_fit(lengths: np.ndarray, order: np.ndarray, capacity: int) -> np.ndarray:
    bins, out = Bins([], capacity, 0), np.empty(len(lengths), np.int32)
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        out[i] = bins.place(n)
    return out


def fills(packing: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.bincount(packing, weights=lengths)


def fitness(packing: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins, then fuller ones; larger is fitter."""
    full = fills(packing, lengths)
    full = full[full > 0]
    return -len(full), float(np.square(full / capacity).sum())


def crossover(host: np.ndarray, donor: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Whole well-filled bins of ``donor`` go into ``host``; displaced documents are placed by best fit, largest first."""
    donor_fill, host_fill = fills(donor, lengths), fills(host, lengths)
    used = np.flatnonzero(donor_fill)
    good = used[donor_fill[used] >= np.quantile(donor_fill[used], 0.5)]
    chosen = rng.choice(good, max(1, len(good) // 3), replace=False)
    injected = np.isin(donor, chosen)
    hit = np.zeros(len(host_fill), bool)
    hit[host[injected]] = True
    # The emptiest bins of the host go as well, so that their documents can fill gaps.
    kept = np.flatnonzero((host_fill > 0) & ~hit)
    if len(kept) > 2:
        hit[kept[np.argsort(host_fill[kept])[: max(2, len(kept) // 20)]]] = True
    child = np.full(len(host), -1, np.int64)
    stay = ~hit[host]
    child[stay & ~injected] = host[stay & ~injected]
    child[injected] = donor[injected] + len(host_fill)
    placed = child >= 0
    full = fills(child[placed], lengths[placed])
    room = [(capacity - int(f), b) for b, f in enumerate(full.tolist()) if 0 < f < capacity]
    bins = Bins(room, capacity, len(full))
    free = np.flatnonzero(~placed)
    for i in free[np.argsort(-lengths[free], kind="stable")].tolist():
        child[i] = bins.place(int(lengths[i]))
    return np.unique(child, return_inverse=True)[1].astype(np.int32)


def evolve(lengths: np.ndarray, capacity: int, population: list[np.ndarray], generations: int, size: int, rng: np.random.Generator, told: dict | None = None) -> list[np.ndarray]:
    """The fittest first.  Population is filled up with documents in random orders; ``told`` gets the generations run and the bins of the fittest before and after."""
    population = list(population)
    while len(population) < size:
        population.append(best_fit(lengths, rng.permutation(len(lengths)), capacity))
    score = lambda p: fitness(p, lengths, capacity)
    population.sort(key=score, reverse=True)
    least, run, before = -(-int(lengths.sum()) // capacity), 0, -score(population[0])[0]
    while run < generations and -score(population[0])[0] > least:
        children = []
        for _ in range(max(1, size // 2)):
            a, b = rng.choice(len(population), 2, replace=len(population) < 2)
            children += [crossover(population[a], population[b], lengths, capacity, rng), crossover(population[b], population[a], lengths, capacity, rng)]
        population = sorted(population + children, key=score, reverse=True)[:size]
        run += 1
    if told is not None:
        told |= {"generations": run, "before": before, "after": -score(population[0])[0]}
    return population[:size]


# --- islands over Spark ------------------------------------------------------------------

STATE = "grp long, island int, generations int, before int, elites array<binary>"


def _start(capacity: int, generations: int, size: int):
    go_on = _go_on(0, capacity, generations, size)

    def run(key: tuple, items: pd.DataFrame) -> pd.DataFrame:
        return go_on(key, items, None)

    return run


def _go_on(epoch: int, capacity: int, generations: int, size: int):
    def run(key: tuple, items: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        grp, island = int(key[0]), int(key[1])
        if items.empty:
            return pd.DataFrame({c: [] for c in ("grp", "island", "generations", "before", "elites")})
        lengths = items.sort_values("uid")["length"].to_numpy(np.int64)
        known = [] if states is None else [np.frombuffer(e, "<i4") for elites in states.sort_values("from")["elites"] for e in elites]
        rng = np.random.default_rng([grp & 0x7FFFFFFF, island, epoch])
        told: dict = {}
        best = evolve(lengths, capacity, known, generations, size, rng, told)
        # ``from`` 0 is the island itself: its generations go on, and its start stays what it was.
        own = None if states is None else states[states["from"] == 0].iloc[0]
        run, before = (told["generations"], told["before"]) if own is None else (told["generations"] + int(own["generations"]), int(own["before"]))
        return pd.DataFrame({"grp": [grp], "island": [island], "generations": [run], "before": [before], "elites": [[p.astype("<i4").tobytes() for p in best]]})

    return run


def _winner(capacity: int):
    def run(key: tuple, items: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values("uid").reset_index(drop=True)
        lengths = items["length"].to_numpy(np.int64)
        packings = [np.frombuffer(s[0], "<i4") for s in states.sort_values("island")["elites"] if len(s)]
        if items.empty or not packings:
            return pd.DataFrame({c: [] for c in ("uid", "grp", "bin", "offset", "fill", "generations", "saved")})
        best = max(packings, key=lambda p: fitness(p, lengths, capacity))
        order = np.lexsort((-lengths, best))
        sums = np.cumsum(lengths[order]) - lengths[order]
        starts = np.unique(best[order], return_index=True)[1]
        offset = np.empty(len(items), np.int64)
        offset[order] = sums - np.repeat(sums[starts], np.diff([*starts, len(order)]))
        return pd.DataFrame({"uid": items["uid"], "grp": int(key[0]), "bin": best, "offset": offset, "fill": fills(best, lengths)[best].astype(np.int64), "generations": int(states["generations"].max()), "saved": int(states["before"].min() - len(starts))})

    return run


def pack_items(items: DataFrame, capacity: int = LENGTH, group: int = GROUP, salt: int = 0, name: str = "packed") -> DataFrame:
    """(uid, grp, bin, offset, fill, generations, saved) of items (uid long, distinct; length int, at most ``capacity``)."""
    groups = max(1, -(-items.count() // group))
    items = items.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(groups)).alias("grp"))
    spread = items.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    by = ["grp", "island"]
    states = spread.groupBy(by).applyInPandas(_start(capacity, GENERATIONS, POPULATION), STATE)
    for epoch in range(1, EPOCHS):
        states = store.materialize(states, "islands")
        own = states.select("grp", "island", F.lit(0).alias("from"), "generations", "before", "elites")
        moved = states.select("grp", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.lit(1).alias("from"), "generations", "before", F.slice("elites", 1, 1).alias("elites"))
        states = spread.groupBy(by).cogroup(own.unionByName(moved).groupBy(by)).applyInPandas(_go_on(epoch, capacity, GENERATIONS, POPULATION), STATE)
    return store.materialize(items.groupBy("grp").cogroup(states.groupBy("grp")).applyInPandas(_winner(capacity), "uid long, grp long, bin int, offset long, fill long, generations int, saved int"), name)


def evolution(packed: DataFrame) -> DataFrame:
    """(grp, items, bins, generations, saved) of each group of ``pack_items``: bins saved over the best packing that an island started with."""
    return packed.groupBy("grp").agg(F.count("*").alias("items"), F.count_distinct("bin").alias("bins"), F.max("generations").alias("generations"), F.max("saved").alias("saved"))


PIECES = "uid long, doc_id long, piece int, start long, length int, ids_crc32 long"


def _cut(file: str, path: str | None, end_id: int, capacity: int):
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, uid = encoder(file, path), TaskContext.get().partitionId() << 36
        for rows in batches:
            out = []
            for key, text in zip(rows["doc_id"].astype("object").where(rows["doc_id"].notna(), None), rows["text"]):
                ids = coder.encode(text if isinstance(text, str) else None) + tail
                for k in range(0, len(ids), 4 * capacity):
                    part = ids[k : k + 4 * capacity]
                    out.append((uid, key, k // 4 // capacity, k // 4, len(part) // 4, zlib.crc32(part)))
                    uid += 1
            yield pd.DataFrame(out, columns=["uid", "doc_id", "piece", "start", "length", "ids_crc32"]).astype({"doc_id": "Int64"})

    return run


def pack_documents(docs: DataFrame, capacity: int = LENGTH, file: str = VOCABULARY, end_id: int = END_ID, path: str | None = None, group: int = GROUP) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(_cut(file, path, end_id, capacity), PIECES)
    pieces = store.materialize(pieces, "pieces")
    shorter = pieces.where(F.col("length") < capacity).select("uid", "length")
    first = pack_items(shorter, capacity, group, 0, "packed")
    good = first.where(F.col("fill") >= int(WELL_FILLED * capacity)).withColumn("round", F.lit(0))
    pooled = first.where(F.col("fill") < int(WELL_FILLED * capacity)).select("uid")
    again = pack_items(shorter.join(pooled, "uid"), capacity, group, 1, "repacked").withColumn("round", F.lit(1))
    placed = good.unionByName(again).select("uid", ((F.col("grp") * (group * 8) + F.col("bin")) * 2 + F.col("round")).alias("packed"), "offset")
    columns = ["doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32"]
    joined = pieces.join(placed, "uid", "left")
    # Full pieces have numbers below zero.
    return joined.select(*columns, F.coalesce("packed", -1 - F.col("uid")).alias("sequence_id"), F.coalesce("offset", F.lit(0).cast("long")).alias("offset"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(store.table(spark, sf_dir, "documents"))
