"""First sights in a stream by Bloom filters of bounded size, in generations of event time.

A row passes if no copy of its key is known from its own generation or the one before; a copy that is
dropped counts as seen too.  A filter of a generation starts a further one, of half the error, when
it holds what it was made for, so a generation's error stays at about ``error`` however many keys come; a row asks two.
A wrong positive drops a row that is no copy; no copy within a generation ever passes.
State needs the RocksDB store (``timed.use_state_store``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .streams import LATE

HELPERS = ("_us", "_generation", "_a", "_b", "_bucket")


class Bits:
    """A Bloom filter for ``room`` keys; a key is two 64-bit hashes, of which its places are sums."""

    def __init__(self, room: int, error: float, bits: bytes | None = None):
        self.size = max(64, math.ceil(-room * math.log(error) / math.log(2) ** 2))
        self.hashes = max(1, round(self.size / room * math.log(2)))
        self.bits = np.zeros(-(-self.size // 8), np.uint8) if bits is None else np.frombuffer(bits, np.uint8).copy()

    def _places(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        step = np.arange(self.hashes, dtype=np.uint64)[:, None]
        return (a[None, :] + step * (b | np.uint64(1))[None, :]) % np.uint64(self.size)

    def has(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        at = self._places(a, b)
        return ((self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        at = self._places(a, b).ravel()
        np.bitwise_or.at(self.bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


class Seen(StatefulProcessor):
    """The filters of one bucket of keys: a map from (generation, part) to bits and the number of keys in them."""

    def __init__(self, columns: list[str], room: int, error: float, span_us: int):
        self.columns, self.room, self.error, self.span = columns, room, error, span_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.filters = handle.getMapState("filters", "generation long, part int", "bits binary, keys long")

    def _parts(self, generation: int, held: set, read: dict) -> list[tuple[Bits, int]]:
        """The filters of a generation, read from state at most once a batch."""
        if generation not in read:
            out = read[generation] = []
            while (generation, len(out)) in held:
                bits, keys = self.filters.getValue((generation, len(out)))
                out.append((Bits(self.room, self.error / 2 ** (len(out) + 1), bytes(bits)), keys))
        return read[generation]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # a sort by time and generation: an older generation is in its filter before the next one asks
        batches = [b for b in rows if len(b)]
        if not batches:
            return
        held = pd.concat(batches, ignore_index=True).set_axis([*self.columns, *HELPERS], axis=1)  # names that begin with _ do not come through
        held = held.sort_values(["_generation", "_us"], kind="stable")
        names, read, passed = {(k[0], k[1]) for k in self.filters.keys()}, {}, []
        for generation, own in held.groupby("_generation", sort=True):
            generation = int(generation)
            own = own.drop_duplicates(["_a", "_b"])
            a, b = own["_a"].to_numpy().view(np.uint64), own["_b"].to_numpy().view(np.uint64)
            parts = self._parts(generation, names, read)
            here = np.zeros(len(own), bool)
            for bits, _ in parts:
                here |= bits.has(a, b)
            known = here.copy()
            for bits, _ in self._parts(generation - 1, names, read):
                known |= bits.has(a, b)
            passed.append(own[~known])
            self._remember(generation, parts, a[~here], b[~here])
        if passed:
            yield pd.concat(passed)[self.columns]

    def _remember(self, generation: int, parts: list[tuple[Bits, int]], a: np.ndarray, b: np.ndarray) -> None:
        if not parts:  # the next generation asks for these filters until its own end
            self.handle.registerTimer((generation + 2) * self.span // 1000)
        done, at = 0, max(len(parts) - 1, 0)
        while done < len(a):
            bits, keys = parts[at] if at < len(parts) else (Bits(self.room, self.error / 2 ** (at + 1)), 0)
            take = min(self.room - keys, len(a) - done)
            if take:
                bits.add(a[done : done + take], b[done : done + take])
                self.filters.updateValue((generation, at), (bits.bits.tobytes(), keys + take))
                parts[at : at + 1] = [(bits, keys + take)]
            done, at = done + take, at + 1

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        over, part = expiredTimerInfo.getExpiryTimeInMs() * 1000 // self.span - 2, 0
        while self.filters.containsKey((over, part)):
            self.filters.removeKey((over, part))
            part += 1
        return iter(())

    def close(self) -> None:
        pass


def _first(key: list[str]):
    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield rows.sort_values("_us", kind="stable").drop_duplicates(key)

    return keep


def first_seen(stream: DataFrame, *keys: str, generation_seconds: int = 86_400, capacity: int = 1 << 20, error: float = 1e-6, late: str = LATE, buckets: int = 64) -> DataFrame:
    """Rows whose key is new to their generation and the one before.

    ``capacity`` keys a generation fit the first filters, about ``capacity * log2(1 / error) * 1.5`` bits in all.
    Rows without a time or with a null in their key have no copies and pass.  Of copies in one batch the earliest
    passes.  Rows behind the watermark are dropped by Spark.  A key that most rows have comes down to one row
    a generation in each Arrow batch before it is shuffled.
    """
    columns, span = stream.columns, generation_seconds * 1_000_000
    whole = F.col("ts").isNotNull()
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    us = F.unix_micros("ts")
    rows = stream.where(whole).withColumns({"_us": us, "_generation": F.floor(us / span).cast("long"), "_a": F.xxhash64(*keys), "_b": F.xxhash64(F.lit("second"), *keys)})
    rows = rows.mapInPandas(_first(["_generation", "_a", "_b"]), rows.schema).withWatermark("ts", late)
    rows = rows.withColumn("_bucket", F.pmod("_a", F.lit(buckets)).cast("int"))
    made = Seen(columns, max(64, -(-capacity // buckets)), error, span)
    out = rows.groupBy("_bucket").transformWithStateInPandas(made, stream.schema, "append", "eventTime")
    return out.unionByName(stream.where(~whole))
