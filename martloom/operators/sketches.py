"""Quantiles and distinct counts from sketches that are kept per group and merged later.

A sketch per month answers for any set of months without reading their rows again. Quantile sketches (KLL) and distinct
counts (theta) have errors that do not depend on the number of rows; both are exact while a group is small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.numbers import finite

#: Size of a quantile sketch, and the binary logarithm of the values a distinct count keeps.
K, LOG_VALUES = 1024, 12


def rank_error(k: int = K) -> float:
    """The share of rows by which a quantile's rank is off with a probability of less than 1 %, as published for KLL."""
    return 2.296 / k**0.9723


def quantile_sketches(df: DataFrame, value: str, by: Sequence[str], k: int = K) -> DataFrame:
    """One row per group: ``sketch`` and ``n``, the numbers it holds. NaN, infinite and missing values are skipped."""
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(finite(value), k).alias("sketch"), F.count(finite(value)).alias("n"))


def merge_quantiles(sketches: DataFrame, quantiles: dict[str, float], by: Sequence[str] = (), k: int = K) -> DataFrame:
    """``n`` and the named ``quantiles`` per group of :func:`quantile_sketches`; NULL where there are no values."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", k).alias("_sketch"), F.sum("n").alias("n"))
    found = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("_sketch", F.lit(float(q)))).alias(name) for name, q in quantiles.items()]
    return merged.select(*by, "n", *found)


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str], log_values: int = LOG_VALUES) -> DataFrame:
    """One row per group with a sketch of the distinct values of each column, under the column's name."""
    return df.groupBy(*by).agg(*[F.theta_sketch_agg(c, log_values).alias(c) for c in columns])


def distinct_counts(sketches: DataFrame, names: dict[str, str], by: Sequence[str] = (), log_values: int = LOG_VALUES) -> DataFrame:
    """Distinct values per group of :func:`distinct_sketches`; ``names``: the result's name by column.

    Exact up to 2 ** ``log_values`` values of a group; beyond, the standard error is 2 ** (-``log_values`` / 2), 1.6 % by default.
    """
    return sketches.groupBy(*by).agg(
        *[F.theta_sketch_estimate(F.theta_union_agg(c, log_values)).alias(name) for c, name in names.items()]
    )
