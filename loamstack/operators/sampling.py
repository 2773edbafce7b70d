"""Deterministic samples, selections, packing by length and sequential folds."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import unit_interval
from ..functions.scores import example_difficulty, length_difficulty
from ..rounds import drop, kept


def uniform(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    return df.orderBy(unit_interval(F.col(key), seed=seed), key).limit(n)


def weighted(df: DataFrame, n: int, key: str, weight: Column, seed: int = 0) -> DataFrame:
    """Without replacement, by exponential keys -ln(u) / w: the n smallest."""
    u = F.greatest(unit_interval(F.col(key), seed=seed), F.lit(1e-12))
    return df.withColumn("_k", F.when(weight > 0, -F.log(u) / weight)).where("_k IS NOT NULL").orderBy("_k", key).limit(n).drop("_k")


def weighted_with_replacement(df: DataFrame, n: int, key: str, weight: Column, seed: int = 0, buckets: int = 1024) -> DataFrame:
    """n draws in proportion to the weights: each draw falls into one row's part of the cumulative weight.

    Cumulative weights come from bucket totals, and draws join rows by bucket, so no task holds all.
    """
    rows = df.withColumns({"_w": weight.cast("double"), "_b": F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")}).where("_w > 0")
    totals = rows.groupBy("_b").agg(F.sum("_w").alias("_t"))  # at most ``buckets`` rows
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_b", F.coalesce(F.sum("_t").over(before), F.lit(0.0)).alias("_s"), "_t", F.sum("_t").over(Window.partitionBy()).alias("_all"))
    upto = F.sum("_w").over(Window.partitionBy("_b").orderBy(key).rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("_to", upto).withColumn("_from", F.col("_to") - F.col("_w"))
    draws = df.sparkSession.range(n).withColumn("_u", unit_interval(F.col("id"), seed=seed))
    placed = draws.join(F.broadcast(starts), (F.col("_u") * F.col("_all") >= F.col("_s")) & (F.col("_u") * F.col("_all") < F.col("_s") + F.col("_t")))
    placed = placed.select(F.col("id").alias("draw"), "_b", (F.col("_u") * F.col("_all") - F.col("_s")).alias("_at"))
    return rows.join(placed, "_b").where((F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_to"))).drop("_w", "_b", "_to", "_from", "_at")


def decayed_priority(priority: Column, age_days: Column, decay: float = 0.999) -> Column:
    return priority * F.pow(F.lit(decay), age_days)


def in_difficulty(df: DataFrame, low: float, high: float, limit: int | None = None, *order: str) -> DataFrame:
    """Rows of the range; all rows where the range has none."""
    inside = F.coalesce(F.col("difficulty").between(low, high), F.lit(False))
    found = df.agg(F.coalesce(F.bool_or(inside), F.lit(False)).alias("_found"))  # one row
    rows = df.join(F.broadcast(found), inside | ~F.col("_found")).drop("_found")
    return rows.orderBy(*order).limit(limit) if limit else rows


def difficulty_range(strategy: str, epoch: int, current: float, start: float = 0.2, end: float = 1.0, step: float = 0.1, width: float = 0.2) -> tuple[float, float]:
    centre = {
        "linear": min(end, start + epoch * step), "exponential": start + (1 - np.exp(-epoch * 0.1)) * (end - start), "anti_curriculum": max(start, end - epoch * step),
    }.get(strategy, current)
    return max(0.0, centre - width), min(1.0, centre + width)


def curriculum_batch(df: DataFrame, size: int, low: float, high: float, key: str, hard: int = 0, seed: int = 0) -> DataFrame:
    """Rows in the range, topped up by priority, with some hard rows in the last places."""
    inside = F.col("difficulty").between(low, high)
    rank = F.struct((~inside).cast("int"), F.when(inside, unit_interval(F.col(key), seed=seed)).otherwise(-F.col("priority")), F.col(key))
    body = df.orderBy(rank).limit(size - hard)
    if not hard:
        return body
    return body.unionByName(df.where("difficulty >= 0.8").join(body.select(key), key, "left_anti").orderBy(F.desc("difficulty"), key).limit(hard))


def per_class(df: DataFrame, label: str, key: str, shots: int, queries: int, ways: int | None = None, seed: int = 0) -> DataFrame:
    """``shots`` support and ``queries`` query rows of each of ``ways`` classes."""
    if ways is not None:
        chosen = df.select(label).distinct().orderBy(unit_interval(F.col(label), seed=seed), label).limit(ways)
        df = df.join(F.broadcast(chosen), label)  # ``ways`` rows
    n = F.row_number().over(Window.partitionBy(label).orderBy(unit_interval(F.col(key), seed=seed), key))
    return df.withColumn("_n", n).where(F.col("_n") <= shots + queries).withColumn("part", F.when(F.col("_n") <= shots, "support").otherwise("query")).drop("_n")


def clients(df: DataFrame, n: int, strategy: str, round_number: int = 0, seed: int = 0) -> DataFrame:
    """Clients of a round: random, round_robin, by size or by loss."""
    if strategy == "random":
        return uniform(df, n, "client_id", seed + round_number)
    if strategy == "round_robin":
        rows = df.withColumn("_n", F.row_number().over(Window.orderBy("client_id")) - 1).withColumn("_all", F.count("*").over(Window.partitionBy()))
        return rows.where(F.pmod(F.col("_n") - round_number * n, F.col("_all")) < n).drop("_n", "_all")
    if strategy == "size":
        return weighted(df, n, "client_id", F.col("num_samples"), seed + round_number)
    return df.orderBy("mean_loss", "client_id").limit(n)


def variant(key: Column, share: float, seed: int = 0) -> Column:
    """a or b, always the same for a key."""
    return F.when(unit_interval(key, seed=seed) < share, "a").otherwise("b")


#: Rounds of a greedy choice after which its state is written, so that plans stay short.
ROUNDS_KEPT = 8


#: Rows, and words in them, that a round of ``diverse`` weighs on the driver.
POOL, POOL_WORDS = 256, 1 << 20


def diverse(df: DataFrame, n: int, key: str, text: str, score: str, weight: float = 0.3, pool: int | None = None) -> DataFrame:
    """Greedy choice of ``n`` rows by score and by difference in words from those chosen: (key, score, place).

    Every row stands for choice, or the ``pool`` best where one is given; rows without key or score do not, a row without
    text has no words.  What a row is worth never rises, so a value known from an earlier round is an upper bound: a round
    takes the ``POOL`` best rows by those bounds and chooses among them as long as the choice beats the best row outside,
    which then is the choice over all rows.  Only then are all rows compared with those newly chosen, in one pass.  Rounds
    grow with the logarithm of ``n`` where values are spread; each chooses at least one row.
    """
    words = F.coalesce(F.array_distinct(F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")), F.array().cast("array<string>"))
    rows = df.select(F.col(key).alias("key"), F.col(score).cast("double").alias("score"), words.alias("words")).where("key IS NOT NULL AND score IS NOT NULL")
    if pool is not None:
        rows = rows.orderBy(F.desc("score"), "key").limit(pool)
    worth = lambda s, o: s * (1 - weight) + weight * (1 - o)
    state = kept(rows.withColumn("overlap", F.lit(0.0)), "choice")
    chosen: list[tuple] = []
    size = POOL
    while len(chosen) < n:
        value = worth(F.col("score"), F.col("overlap")) if chosen else F.col("score")
        top = kept(state.withColumn("value", value).orderBy(F.desc("value"), F.desc("score"), "key").limit(size + 1), "pool")
        best = top.select("key", "score", "overlap", "value", F.size("words").alias("n")).collect()  # size + 1 rows without their words
        best.sort(key=lambda r: (-r["value"], -r["score"], r["key"]))
        within = np.cumsum([r["n"] for r in best]) <= POOL_WORDS
        most = len(best) if len(best) <= size and within.all() else max(1, min(size, int(within.sum())))
        if not best:
            drop(top)
            break
        limit = (-best[most]["value"], -best[most]["score"], best[most]["key"]) if most < len(best) else None
        taken = _chosen_from(top, best[:most], limit, n - len(chosen), worth, not chosen)
        drop(top)
        chosen += [(k, s, len(chosen) + i) for i, (k, s, _) in enumerate(taken)]
        if limit is None or len(chosen) >= n:
            break
        size = min(size * 2, POOL * 64) if len(taken) * 4 < most else size
        state, done = kept(_compared(state, [w for _, _, w in taken], [k for k, _, _ in taken]), "choice"), state
        drop(done)
    drop(state)
    return df.sparkSession.createDataFrame(chosen, f"{key} {dict(df.dtypes)[key]}, score double, place int")


def _chosen_from(top: DataFrame, best: list, limit: tuple | None, n: int, worth, first: bool) -> list[tuple]:
    """(key, score, words) of up to ``n`` choices among ``best`` that no row outside can beat."""
    texts = {r["key"]: frozenset(r["words"]) for r in top.where(F.col("key").isin([r["key"] for r in best])).select("key", "words").collect()}  # POOL_WORDS words or one row
    left = {}
    for r in best:
        left.setdefault(r["key"], [r["score"], r["overlap"]])
    out: list[tuple] = []
    while left and len(out) < n:
        rank = lambda k: (-(left[k][0] if first and not out else worth(*left[k])), -left[k][0], k)
        k = min(left, key=rank)
        if out and limit is not None and not rank(k) < limit:
            break
        s, _ = left.pop(k)
        out.append((k, s, texts[k]))
        if first and len(out) == 1:
            limit = None if limit is None else (-worth(-limit[0], 0.0), *limit[1:])  # scores bound the values that count from now on
        for other, held in left.items():
            if texts[other]:
                held[1] = max(held[1], len(texts[other] & texts[k]) / len(texts[other]))
    return out


def _compared(state: DataFrame, chosen: list[frozenset], keys: list) -> DataFrame:
    """``state`` without the chosen keys, with each row's largest share of words that one of ``chosen`` has too."""
    where: dict[str, list[int]] = {}
    for i, words in enumerate(chosen):
        for w in words:
            where.setdefault(w, []).append(i)
    index, count = state.sparkSession.sparkContext.broadcast(where), len(chosen)  # words of one round's choices: POOL_WORDS, or one row's

    @F.pandas_udf("double")
    def share(words: pd.Series) -> pd.Series:
        out = []
        for own in words:
            shared = np.zeros(count, np.int64)
            for w in own:
                at = index.value.get(w)
                if at is not None:
                    shared[at] += 1
            out.append(shared.max() / len(own) if len(own) else 0.0)
        return pd.Series(out, dtype="float64")

    return state.where(~F.col("key").isin(keys)).withColumn("overlap", F.greatest("overlap", share("words")))


def k_centres(df: DataFrame, k: int, key: str, vector: str) -> DataFrame:
    """Greedy core set of (key, place): the first row in hash order, then always the row furthest from those chosen."""
    far = lambda v: F.sqrt(F.aggregate(F.zip_with(vector, F.array(*[F.lit(float(x)) for x in v]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    first = state = kept(df.select(key, vector).withColumn("distance", F.lit(float("inf"))), "centres")
    order = [F.desc("distance"), unit_interval(F.col(key)), F.col(key)]
    chosen: list[tuple] = []
    while len(chosen) < k:
        best = state.orderBy(*order).limit(1).collect()  # one row
        if not best:
            break
        chosen.append((best[0][key], len(chosen)))
        state = state.where(F.col(key) != F.lit(best[0][key])).withColumn("distance", F.least("distance", far(best[0][vector])))
        if len(chosen) % ROUNDS_KEPT == 0:
            state, done = kept(state, "centres"), first
            drop(done)
            first = state
    drop(first)
    return df.sparkSession.createDataFrame(chosen, f"{key} {dict(df.dtypes)[key]}, place int")


#: Queries that are sent to all tasks at once, rows and queries of one matrix product, pairs whose cosines are worked out at once.
QUERIES, SLICE, QUERY_BLOCK, PAIRS = 1 << 15, 4096, 1024, 1 << 16
#: More than a matrix product's cosine of unit vectors may differ from one that is summed in order.
SLACK = 1e-9


def _matrices(lists: list) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By width: rows that have a direction (nothing null or non-finite, not all 0), and which of the lists they are."""
    widths, out = np.array([0 if v is None else len(v) for v in lists], np.int64), {}
    for width in np.unique(widths[widths > 0]).tolist():
        at = np.flatnonzero(widths == width)
        x = np.array([np.asarray(lists[i], np.float64) for i in at])
        fine = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
        if fine.any():
            out[width] = x[fine], at[fine]
    return out


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of rows, summed in order, so that equal rows have equal cosines wherever they stand."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


class _Nearest:
    """The k best (cosine, id) of each query so far."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int):
        self.ids, self.x, self.unit, self.square, self.k = ids, x, _units(x), _dot(x, x), k
        self.least = np.full(len(ids), -np.inf)
        self.query, self.id, self.cosine = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def take(self, ids: np.ndarray, x: np.ndarray) -> None:
        unit, square, found = _units(x), _dot(x, x), [(self.query, self.id, self.cosine)]
        for begin in range(0, len(self.ids), QUERY_BLOCK):
            near = self.unit[begin : begin + QUERY_BLOCK] @ unit.T
            near[self.ids[begin : begin + QUERY_BLOCK, None] == ids[None, :]] = -np.inf
            least = self.least[begin : begin + QUERY_BLOCK]
            if len(ids) > self.k:
                least = np.maximum(least, np.partition(near, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
            i, j = np.nonzero((near >= least[:, None] - SLACK) & np.isfinite(near))
            for at in range(0, len(i), PAIRS):
                q, r = begin + i[at : at + PAIRS], j[at : at + PAIRS]
                found.append((q, ids[r], _dot(x[r], self.x[q]) / np.sqrt(square[r] * self.square[q])))
        query, id_, cosine = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((id_, -cosine, query))
        query, id_, cosine = query[order], id_[order], cosine[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        best = place < self.k
        self.query, self.id, self.cosine = query[best], id_[best], cosine[best]
        last = place == self.k - 1
        self.least[query[last]] = cosine[last]


def nearest(queries: DataFrame, vectors: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k rows of highest cosine for each query, ties by key; keys are whole numbers.

    Queries are sent to all tasks in blocks of about ``QUERIES``; a task multiplies its rows with them slice by slice
    and hands on only its k best of each.  Products choose candidates, whose cosines are then summed in order.
    Null and zero vectors and those with null or non-finite components have no cosine and come last.
    """
    spark, kind = queries.sparkSession, dict(vectors.dtypes)[key]
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).where("id IS NOT NULL")
    q = kept(queries.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).where("id IS NOT NULL"), "queries")
    blocks = max(1, -(-q.count() // QUERIES))

    def parts(block: int) -> DataFrame:
        asked = q.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toPandas()  # about ``QUERIES`` rows
        ids = asked["id"].to_numpy(np.int64)
        sent = spark.sparkContext.broadcast({width: (ids[at], x) for width, (x, at) in _matrices(list(asked["v"])).items()})

        def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            states = {width: _Nearest(ids, x, k) for width, (ids, x) in sent.value.items()}
            for batch in batches:
                for begin in range(0, len(batch), SLICE):
                    part = batch.iloc[begin : begin + SLICE]
                    for width, (x, at) in _matrices(list(part["v"])).items():
                        if width in states:
                            states[width].take(part["id"].to_numpy(np.int64)[at], x)
            for s in states.values():
                yield pd.DataFrame({"query": s.ids[s.query], "id": s.id, "cosine": s.cosine})

        return rows.mapInPandas(best, "query long, id long, cosine double")

    turned = lambda v: F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))
    first = lambda df: F.broadcast(df.select("id").orderBy("id").limit(k + 1))
    without = q.where(turned("v")).select(F.col("id").alias("query")).crossJoin(first(rows.where(~turned("v"))))
    without = without.unionByName(q.where(~turned("v")).select(F.col("id").alias("query")).crossJoin(first(rows)))
    without = without.where("id <> query").withColumn("cosine", F.lit(None).cast("double"))
    out = reduce(DataFrame.unionByName, map(parts, range(blocks)), without)
    n = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("cosine"), "id"))
    return out.withColumn("rank", n).where(F.col("rank") <= k).select(F.col("query").cast(kind).alias("query"), "rank", F.col("id").cast(kind).alias(key), "cosine")


def length_batches(df: DataFrame, key: str, length: str, max_tokens: int, max_items: int, group: str | None = None) -> DataFrame:
    """Longest first, batches closed by tokens or items; sequential within a group of rows."""
    rows = df.withColumn("_g", F.lit(0) if group is None else F.col(group))

    def fold(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values([length, key], ascending=[False, True])
        batch, tokens, items, out = 0, 0, 0, []
        for n in part[length]:
            if tokens + n > max_tokens and items:
                batch, tokens, items = batch + 1, 0, 0
            out.append(batch)
            tokens, items = tokens + n, items + 1
            if items >= max_items:
                batch, tokens, items = batch + 1, 0, 0
        return part.assign(batch=out)

    return rows.groupBy("_g").applyInPandas(fold, rows.withColumn("batch", F.lit(0).cast("long")).schema).drop("_g")


def competence_path(scores: Column, threshold: float = 0.8, step: float = 0.1, patience: int = 3, start: float = 0.2, end: float = 1.0) -> Column:
    """Difficulty after an ordered array of accuracies, by rolling means of the last five."""
    state = F.struct(F.lit(float(start)).alias("d"), F.lit(0).alias("stale"), F.array().cast("array<double>").alias("seen"))

    def move(s, x):
        seen = F.concat(s["seen"], F.array(x))
        recent = F.when(F.size(seen) > 5, F.slice(seen, -5, 5)).otherwise(seen)
        mean = F.aggregate(recent, F.lit(0.0), lambda a, v: a + v) / F.size(recent)
        early, good, tired = F.size(seen) < 3, mean >= threshold, s["stale"] + 1 >= patience
        d = F.when(early, s["d"]).when(good, F.least(F.lit(float(end)), s["d"] + step)).when(tired, F.least(F.lit(float(end)), s["d"] + step / 2)).otherwise(s["d"])
        stale = F.when(early, s["stale"]).when(good | tired, 0).otherwise(s["stale"] + 1)
        return F.struct(d.alias("d"), stale.alias("stale"), seen.alias("seen"))

    return F.aggregate(scores, state, move, lambda s: s["d"])


def early_stop(values: Column, patience: int, min_delta: float = 0.0, lower_is_better: bool = True) -> Column:
    """Place (from 0) of the evaluation that stops training; null if none does."""
    sign = -1.0 if lower_is_better else 1.0
    state = F.struct(F.lit(-1e308).alias("best"), F.lit(0).alias("bad"), F.lit(0).alias("i"), F.lit(-1).alias("stop"))

    def move(s, x):
        v = x.cast("double") * sign
        better = v > s["best"] + min_delta
        bad = F.when(better, 0).otherwise(s["bad"] + 1)
        stop = F.when((s["stop"] < 0) & (bad >= patience), s["i"]).otherwise(s["stop"])
        return F.struct(F.when(better, v).otherwise(s["best"]).alias("best"), bad.alias("bad"), (s["i"] + 1).alias("i"), stop.alias("stop"))

    return F.aggregate(values, state, move, lambda s: F.when(s["stop"] >= 0, s["stop"]))


def stage_advances(rows: DataFrame, run: str, order: str, metric: str, min_improvement: float = 0.01, patience: int = 3, success: float = 0.9) -> DataFrame:
    """Epochs at which a stage may end: no gain for ``patience`` epochs, or the mean of the last five is enough."""
    w = Window.partitionBy(run).orderBy(order)
    out = rows.withColumn("_vals", F.collect_list(metric).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    state = F.struct(F.lit(-1e308).alias("best"), F.lit(0).alias("bad"))
    stale = F.aggregate("_vals", state, lambda s, x: F.when(x > s["best"] + min_improvement, F.struct(x.cast("double").alias("best"), F.lit(0).alias("bad"))).otherwise(F.struct(s["best"].alias("best"), (s["bad"] + 1).alias("bad"))), lambda s: s["bad"])
    return out.withColumns({"stale": stale, "recent": F.avg(metric).over(w.rowsBetween(-4, 0))}).withColumn("advance", (F.col("stale") >= patience) | (F.col("recent") >= success)).drop("_vals")


def advantages(steps: Column, gamma: float = 0.99, lam: float = 0.95) -> Column:
    """Generalised advantages of an ordered array of (reward, value, done), by a fold from the end."""
    back = F.reverse(steps)
    state = F.struct(F.lit(0.0).alias("next"), F.lit(0.0).alias("gae"), F.array().cast("array<double>").alias("out"))

    def move(s, x):
        live = 1.0 - x["done"].cast("double")
        delta = x["reward"] + gamma * s["next"] * live - x["value"]
        gae = delta + gamma * lam * live * s["gae"]
        return F.struct(x["value"].cast("double").alias("next"), gae.alias("gae"), F.concat(F.array(gae), s["out"]).alias("out"))

    return F.aggregate(back, state, move, lambda s: s["out"])


def token_bucket(requests: DataFrame, key: str, ts: str, cost: str, rate: float, capacity: float) -> DataFrame:
    """``allowed`` for each request of a key under a bucket that refills at ``rate`` a second."""
    schema = requests.withColumns({"allowed": F.lit(True), "left": F.lit(0.0)}).schema

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(ts)
        level, last, ok, left = capacity, None, [], []
        for t, c in zip(part[ts], part[cost]):
            level = level if last is None else min(capacity, level + rate * (t - last).total_seconds())
            last = t
            ok.append(level >= c)
            level -= c if ok[-1] else 0
            left.append(level)
        return part.assign(allowed=ok, left=left)

    return requests.groupBy(key).applyInPandas(run, schema)


def z_normalised(values: Column) -> Column:
    """An array less its mean, over its deviation."""

    def scale(v: Column) -> Column:
        n = F.size(v)
        mean = F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / n
        sd = lambda m: F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + (x - m) * (x - m)) / n)
        return F.transform(F.array(F.struct(mean.alias("m"))), lambda s: F.transform(F.array(sd(s["m"])), lambda d: F.transform(v, lambda x: (x - s["m"]) / (d + 1e-8)))[0])[0]

    return F.transform(F.array(values), scale)[0]


def buffer_statistics(buffer: DataFrame, name: str, priority: str, age: str, old: float) -> DataFrame:
    """Size, total priority and number of aged entries of each part of a replay buffer."""
    return buffer.groupBy(name).agg(F.count("*").alias("n"), F.sum(priority).alias("priorities"), F.count_if(F.col(age) > old).alias("old"))


def distribution(buffer: DataFrame, most: int, *columns: str) -> DataFrame:
    """(column, level, n, fill_rate): entries by each level of each column, and how full the buffer is."""
    long = buffer.unpivot([], [F.col(c).cast("string").alias(c) for c in columns], "column", "level")
    size = F.sum("n").over(Window.partitionBy("column"))  # a row for each level
    return long.groupBy("column", "level").agg(F.count("*").alias("n")).withColumn("fill_rate", size / most)


#: Difficulty scorers by name, each from a frame's text column to a column; others can be added.
SCORERS = {"length": length_difficulty, "vocabulary": lambda text: example_difficulty(text, F.lit("none"))}


def with_difficulty(df: DataFrame, scorer, text: str = "text") -> DataFrame:
    """``difficulty`` by a scorer's name or by a function of the text column."""
    return df.withColumn("difficulty", (SCORERS[scorer] if isinstance(scorer, str) else scorer)(F.col(text)))


def clustered(df: DataFrame, k: int, key: str, vector: str, score: str | None = None, weight: float = 0.5, seed: int = 1) -> DataFrame:
    """One row of each of ``k`` clusters: that nearest its centre, or of the best mean of nearness and ``score``."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = df.withColumn("_v", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))
    model = KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="cluster").fit(rows)
    centres = df.sparkSession.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cluster int, _c array<double>")  # k rows
    rows = model.transform(rows).drop("_v").join(F.broadcast(centres), "cluster")
    far = F.sqrt(F.aggregate(F.zip_with(vector, "_c", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    value = -far if score is None else weight * F.col(score) + (1 - weight) / (1 + far)
    n = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("_value"), key))
    return rows.withColumn("_value", value).withColumn("_n", n).where("_n = 1").drop("_n", "_c", "_value")
