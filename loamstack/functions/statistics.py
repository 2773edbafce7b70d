"""Percentiles of both kinds, tests of means, and p-values."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def percentiles(value: Column, points=(0.5, 0.9, 0.95, 0.99)) -> Column:
    """Exact, with linear interpolation."""
    return F.percentile(value, F.array(*map(F.lit, points)))


def index_percentile(value: Column, point: float) -> Column:
    """The sorted value at place int(n * p), for groups of a bounded size."""
    held = F.sort_array(F.collect_list(value))
    return F.try_element_at(held, F.least(F.floor(F.size(held) * F.lit(point)).cast("int") + 1, F.size(held)))


def lower_median(value: Column) -> Column:
    """The middle value; of two, the lower."""
    held = F.sort_array(F.collect_list(value))
    return F.element_at(held, F.floor((F.size(held) + 1) / 2).cast("int"))


def trimmed_mean(value: Column, share: float = 0.2) -> Column:
    """Mean without int(n * share / 2) values at either end."""
    held = F.sort_array(F.collect_list(value))
    cut = F.floor(F.size(held) * F.lit(share) / 2).cast("int")
    kept = F.slice(held, cut + 1, F.size(held) - 2 * cut)
    return F.aggregate(kept, F.lit(0.0), lambda a, x: a + x) / F.size(kept)


def t_statistic(mean_a: Column, sd_a: Column, n_a: Column, mean_b: Column, sd_b: Column, n_b: Column) -> Column:
    """Difference of means over Welch's standard error; null where both deviations are 0."""
    error = F.sqrt(sd_a * sd_a / n_a + sd_b * sd_b / n_b)
    return F.when(error > 0, (mean_a - mean_b) / error)


@F.pandas_udf(DoubleType())
def normal_p_value(t: pd.Series) -> pd.Series:
    """Two-tailed, by the normal approximation."""
    return t.map(lambda x: None if x is None or x != x else 1 - math.erf(abs(x) / math.sqrt(2)))


def change_severity(percent: Column) -> Column:
    size = F.abs(percent)
    return F.when(size > 20, "critical").when(size > 10, "high").when(size > 5, "medium").otherwise("low")
