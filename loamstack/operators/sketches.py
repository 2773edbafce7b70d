"""Mergeable sketches of metrics: kept by minute, merged into hours and days without the rows.

A KLL sketch answers percentiles: the share of values up to its answer is within ``RANK_ERROR`` of
the share asked for, at 99 % confidence and for any distribution; merging keeps that bound, and a sketch that has
seen no more than ``KLL_SIZE`` values is exact.  A HyperLogLog sketch counts distinct values with a relative
standard error of ``1.04 / sqrt(2 ** HLL_BITS)``.  Both are some kilobytes whatever the number of rows, and
are aggregated before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KLL_SIZE, RANK_ERROR = 200, 0.0133
HLL_BITS = 12
DISTINCT_ERROR = 1.04 / 2 ** (HLL_BITS / 2)
PERCENTILES = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def sketched(metrics: DataFrame, seconds: int = 60, keys: tuple[str, ...] = ("name",), distinct: str | None = None) -> DataFrame:
    """(window_start, keys, n, total, low, high, values, ids): sums and sketches by epoch-aligned windows; null values and ids are not counted."""
    ids = [F.hll_sketch_agg(F.col(distinct), F.lit(HLL_BITS)).alias("ids")] if distinct else []
    v = F.col("value")
    rows = metrics.groupBy(F.window("ts", f"{seconds} seconds").alias("w"), *keys).agg(
        F.count(v).alias("n"), F.sum(v).alias("total"), F.min(v).alias("low"), F.max(v).alias("high"), F.kll_sketch_agg_double(v, F.lit(KLL_SIZE)).alias("values"), *ids
    )
    return rows.select(F.col("w.start").alias("window_start"), *keys, "n", "total", "low", "high", "values", *(["ids"] if distinct else []))


def merged(sketches: DataFrame, seconds: int, keys: tuple[str, ...] = ("name",)) -> DataFrame:
    """Larger windows from smaller ones, sketches included."""
    ids = [F.hll_union_agg("ids").alias("ids")] if "ids" in sketches.columns else []
    rows = sketches.groupBy(F.window("window_start", f"{seconds} seconds").alias("w"), *keys).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"), F.kll_merge_agg_double("values").alias("values"), *ids
    )
    return rows.select(F.col("w.start").alias("window_start"), *keys, "n", "total", "low", "high", "values", *(["ids"] if ids else []))


def percentile(share: float, sketch: str = "values") -> Column:
    """Null for a window without values."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(share)))


def answered(sketches: DataFrame) -> DataFrame:
    """Sketches as figures: mean, percentiles and distinct ids."""
    ids = [F.hll_sketch_estimate("ids").alias("distinct")] if "ids" in sketches.columns else []
    left = [c for c in sketches.columns if c not in ("values", "ids")]
    return sketches.select(*left, (F.col("total") / F.col("n")).alias("mean"), *[percentile(p).alias(name) for name, p in PERCENTILES.items()], *ids)


def rank_errors(answers: DataFrame, metrics: DataFrame, seconds: int, keys: tuple[str, ...] = ("name",)) -> DataFrame:
    """(window_start, keys, n, p50 ...): how far each percentile's true rank is from the one asked for; 0 where its ties cover it."""
    rows = metrics.where("value IS NOT NULL").select(F.window("ts", f"{seconds} seconds")["start"].alias("window_start"), *keys, "value")
    joined = rows.join(answers.select("window_start", *keys, *PERCENTILES), ["window_start", *keys])
    n = F.count("*")

    def error(name: str, share: float) -> Column:
        below, upto = F.count_if(F.col("value") < F.col(name)) / n, F.count_if(F.col("value") <= F.col(name)) / n
        return F.greatest(F.lit(0.0), below - share, share - upto).alias(name)

    return joined.groupBy("window_start", *keys).agg(n.alias("n"), *[error(name, p) for name, p in PERCENTILES.items()])
