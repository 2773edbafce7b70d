"""Folds over long series in parts: a key that has all rows is still the work of many tasks.

Rows are dealt by ranges of (key, order) into parts of about ``PART`` rows and stored.  Each part is folded
once for every state that can enter it, which each fold below makes a small summary: an affine map, a few
jumps.  Summaries of a key, not its rows, are folded in order by one task; then each part is gone through
again with the state that enters it.  Null keys are one key; rows of equal order are taken in any order.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..rounds import kept

PART = 1 << 16
OWN = ["_key", "_part", "_n", "_at"]


def placed(rows: DataFrame, keys: list[str], order: list[Column | str], part_rows: int = PART) -> DataFrame:
    """A stored table with ``_key``, ``_part``, the place in the part ``_n`` and in the key ``_at``, all from 0."""
    rows = rows.withColumn("_key", F.to_json(F.struct(*keys)))
    parts = max(1, -(-rows.count() // part_rows))
    stored = kept(rows.repartitionByRange(parts, "_key", *order).withColumn("_part", F.spark_partition_id()), "series")
    before = F.coalesce(F.sum("count").over(Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each part of a key
    starts = stored.groupBy("_key", "_part").count().select("_key", "_part", before.alias("_before"))
    n = F.row_number().over(Window.partitionBy("_key", "_part").orderBy(*order)) - 1
    return kept(stored.withColumn("_n", n.cast("long")).join(starts, ["_key", "_part"]).withColumn("_at", F.col("_before") + F.col("_n")).drop("_before"), "placed")


def _by_part(rows: DataFrame, fold: Callable[[pd.DataFrame], pd.DataFrame], schema: str, part: str = "_part") -> DataFrame:
    def run(part_rows: pd.DataFrame) -> pd.DataFrame:
        return fold(part_rows.sort_values("_at", ignore_index=True))

    return rows.groupBy("_key", part).applyInPandas(run, schema)


def _scanned(summaries: DataFrame, fold: Callable[[pd.DataFrame], pd.DataFrame], schema: str, part: str = "_part", ascending: bool = True) -> DataFrame:
    """Each key's summaries, one row for each of its parts, in order."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return fold(rows.sort_values(part, ascending=ascending, ignore_index=True))

    return summaries.groupBy("_key").applyInPandas(run, schema)


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


# ---------------------------------------------------------------- reverse recurrences


def advantages(rows: DataFrame, keys: list[str], order: list[str], reward: str = "reward", value: str = "value", done: str = "done", gamma: float = 0.99, lam: float = 0.95, part_rows: int = PART) -> DataFrame:
    """``rows`` with their generalised ``advantage``, as ``sampling.advantages`` has it of an array.

    From the end of a part back to a row the recurrence is an affine map of the advantage that follows the part.
    """
    at = placed(rows, keys, order, part_rows)
    firsts = at.where("_n = 0").select("_key", "_part", F.col(value).cast("double").alias("_first"))
    following = firsts.select("_key", "_part", F.lead("_first").over(Window.partitionBy("_key").orderBy("_part")).alias("_next"))

    def back(part: pd.DataFrame) -> pd.DataFrame:
        v, live = part[value].to_numpy(float), 1.0 - part[done].to_numpy(float)
        after = np.append(v[1:], part["_next"].fillna(0.0).iloc[0])
        delta = part[reward].to_numpy(float) + gamma * after * live - v
        gae, scale, local, factor = 0.0, 1.0, np.empty(len(v)), np.empty(len(v))
        for k in range(len(v) - 1, -1, -1):
            c = gamma * lam * live[k]
            gae, scale = delta[k] + c * gae, c * scale
            local[k], factor[k] = gae, scale
        return part.drop(columns=["_next"]).assign(_local=local, _factor=factor)

    local = kept(_by_part(at.join(following, ["_key", "_part"]), back, f"{_schema(at)}, _local double, _factor double"), "local")

    def scan(parts: pd.DataFrame) -> pd.DataFrame:
        gae, out = 0.0, []
        for a, b in zip(parts["_local"], parts["_factor"]):
            out.append(gae)
            gae = a + b * gae
        return parts[["_key", "_part"]].assign(_after=out)

    entering = _scanned(local.where("_n = 0").select("_key", "_part", "_local", "_factor"), scan, "_key string, _part int, _after double", ascending=False)
    joined = local.join(entering, ["_key", "_part"])
    return joined.withColumn("advantage", F.col("_local") + F.col("_factor") * F.col("_after")).drop(*OWN, "_local", "_factor", "_after")


# ---------------------------------------------------------------- cooldowns


def after_cooldown(rows: DataFrame, keys: list[str], ts: str, seconds: float, part_rows: int = PART) -> DataFrame:
    """The rows that fire: each key's first, and then the first at least ``seconds`` after the last that fired.

    What a part does depends on the last firing before it only up to the first row that fires, which is one of its
    first ``seconds`` or the next; the summary has these rows with the last firing that each leads to.
    """
    cool = round(seconds * 1_000_000)
    at = placed(rows.withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp"))), keys, ["_us"], part_rows)

    def jumps(us: np.ndarray) -> np.ndarray:
        return np.maximum(np.searchsorted(us, us + cool), np.arange(len(us)) + 1)

    def summary(part: pd.DataFrame) -> pd.DataFrame:
        us = part["_us"].to_numpy()
        to, last = jumps(us), us.copy()
        for k in range(len(us) - 1, -1, -1):
            if to[k] < len(us):
                last[k] = last[to[k]]
        upto = min(len(us), int(np.searchsorted(us, us[0] + cool)) + 1)
        ends = [k for k in range(upto) if k == upto - 1 or last[k] != last[k + 1]]  # the last of rows that lead to one firing stands for them
        return pd.DataFrame({"_key": [part["_key"].iloc[0]], "_part": [part["_part"].iloc[0]], "_enters": [us[ends].tolist()], "_leaves": [last[ends].tolist()]})

    def scan(parts: pd.DataFrame) -> pd.DataFrame:
        fired, out = None, []
        for enters, leaves in zip(parts["_enters"], parts["_leaves"]):
            out.append(fired)
            k = 0 if fired is None else int(np.searchsorted(enters, fired + cool))
            fired = int(leaves[k]) if k < len(leaves) else fired
        return parts[["_key", "_part"]].assign(_fired=pd.array(out, dtype="Int64"))

    def fire(part: pd.DataFrame) -> pd.DataFrame:
        us, fired = part["_us"].to_numpy(), part["_fired"].iloc[0]
        to, k, keep = jumps(us), 0 if pd.isna(fired) else int(np.searchsorted(us, int(fired) + cool)), []
        while k < len(us):
            keep.append(k)
            k = int(to[k])
        return part.iloc[keep].drop(columns=["_fired"])

    entering = _scanned(_by_part(at, summary, "_key string, _part int, _enters array<long>, _leaves array<long>"), scan, "_key string, _part int, _fired long")
    return _by_part(at.join(entering, ["_key", "_part"]), fire, _schema(at)).drop(*OWN, "_us")


# ---------------------------------------------------------------- greedy batches


def length_batches(rows: DataFrame, key: str, length: str, max_tokens: int, max_items: int, group: str | None = None, part_rows: int = PART) -> DataFrame:
    """``rows`` with their ``batch``, as ``sampling.length_batches`` has it: longest first, closed by tokens or items.

    Where a batch begins its end follows from sums of lengths, so each row knows the next beginning; the first
    that a part has is among its first ``max_items`` rows, and for each of these the summary has the first beginning after the part
    and the batches up to it.  A part also sees the ``max_items`` rows after it.
    """
    part_rows = max(part_rows, max_items)
    at = placed(rows.withColumn("_g", F.lit(0) if group is None else F.col(group)), ["_g"], [F.desc(length), F.asc(key)], part_rows).withColumn("_chunk", F.floor(F.col("_at") / part_rows))
    also = F.when((F.col("_at") % part_rows < max_items) & (F.col("_chunk") > 0), F.array(F.col("_chunk"), F.col("_chunk") - 1)).otherwise(F.array("_chunk"))
    seen = at.select("_key", "_at", F.col("_chunk").alias("_home"), F.col(length).cast("long").alias("_len"), F.explode(also).alias("_chunk"))

    def jumps(part: pd.DataFrame) -> tuple[np.ndarray, int]:
        own, m = int((part["_home"] == part["_chunk"]).sum()), len(part)
        sums = np.concatenate([[0], np.cumsum(part["_len"].to_numpy())])
        begins = np.arange(own)
        ends = np.searchsorted(sums, sums[:own] + max_tokens, "right") - 1
        return np.minimum(np.minimum(np.maximum(ends, begins + 1), begins + max_items), m), own

    def summary(part: pd.DataFrame) -> pd.DataFrame:
        to, own = jumps(part)
        leaves, count = to.copy(), np.ones(own, np.int64)
        for k in range(own - 1, -1, -1):
            if to[k] < own:
                leaves[k], count[k] = leaves[to[k]], count[to[k]] + 1
        few = min(own, max_items)
        return pd.DataFrame({"_key": [part["_key"].iloc[0]], "_chunk": [part["_chunk"].iloc[0]], "_leaves": [(leaves[:few] - own).tolist()], "_count": [count[:few].tolist()]})

    def scan(parts: pd.DataFrame) -> pd.DataFrame:
        enter, base, out = 0, 0, []
        for leaves, count in zip(parts["_leaves"], parts["_count"]):
            out.append((enter, base))
            if enter < len(leaves):
                enter, base = int(leaves[enter]), base + int(count[enter])
        return parts[["_key", "_chunk"]].assign(_enter=[e for e, _ in out], _base=[b for _, b in out])

    def batches(part: pd.DataFrame) -> pd.DataFrame:
        to, own = jumps(part)
        begins, k = np.zeros(own, np.int64), int(part["_enter"].iloc[0])
        while k < own:
            begins[k] = 1
            k = int(to[k])
        return pd.DataFrame({"_key": part["_key"].iloc[:own], "_at": part["_at"].iloc[:own], "batch": part["_base"].iloc[0] - 1 + np.cumsum(begins)})

    entering = _scanned(_by_part(seen, summary, "_key string, _chunk long, _leaves array<long>, _count array<long>", "_chunk"), scan, "_key string, _chunk long, _enter long, _base long", "_chunk")
    told = _by_part(seen.join(entering, ["_key", "_chunk"]), batches, "_key string, _at long, batch long", "_chunk")
    return at.join(told, ["_key", "_at"]).drop(*OWN, "_g", "_chunk")
