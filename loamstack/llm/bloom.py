"""Bloom filters of ids: rows that join with few ids need not all be shuffled.

Rows whose id fails the filter are surely not among the ids; the others, which are those that
are and few more, go on to an exact join.  The filter's size is bounded, so for very many ids
it lets more rows pass, never fewer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store

#: Bits of a filter for each id, its hash functions, and its most bytes.
FILTER_BITS, FILTER_HASHES, FILTER_BYTES = 12, 4, 16 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _places(ids: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Where each id stands in a filter of so many bits, by each hash function."""
    with np.errstate(over="ignore"):
        one = _mix(ids.astype(np.uint64))
        two = _mix(one ^ np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        for k in range(FILTER_HASHES):
            yield (one + two * np.uint64(k)) % np.uint64(bits)


def may_be_among(ids: DataFrame, key: str, count: int):
    """A test of a column of ids that all of ``ids`` pass and few others, by a Bloom filter whose size is bounded by ``FILTER_BYTES``."""
    bits = min(max(count * FILTER_BITS, 1024), 8 * FILTER_BYTES) + 63 & ~63

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = np.zeros(bits // 64, np.uint64)
        for rows in batches:
            for place in _places(rows[key].to_numpy(np.int64), bits):
                np.bitwise_or.at(words, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
        at = np.flatnonzero(words)
        yield pd.DataFrame({"at": at, "word": words[at].view(np.int64)})

    found = ids.select(key).mapInPandas(spread, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()  # at most FILTER_BYTES / 8 rows
    words = np.zeros(bits // 64, np.uint64)
    words[found["at"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    shared = ids.sparkSession.sparkContext.broadcast(words)  # at most FILTER_BYTES

    @F.pandas_udf("boolean")
    def test(column: pd.Series) -> pd.Series:
        known, out = column.notna().to_numpy(), np.zeros(len(column), bool)
        asked, passed = column.to_numpy()[known].astype(np.int64), None
        for place in _places(asked, bits):
            hit = shared.value[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1) == 1
            passed = hit if passed is None else passed & hit
        out[known] = passed
        return pd.Series(out)

    return test


def apart(rows: DataFrame, key: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that may be among ``ids`` (of a column ``key``, a stored table) and those that surely are not; a null key is not."""
    flag = store.unused(rows, "_loam_may")
    test = may_be_among(ids, key, ids.count())
    flagged = rows.withColumn(flag, test(key))
    return flagged.where(flag).drop(flag), flagged.where(~F.col(flag)).drop(flag)
