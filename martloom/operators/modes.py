"""Most frequent value per group when nearly all values come from a known list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_with_mode(
    df: DataFrame, keys: list[str], value: str, listed: Sequence[str], aggs: list[Column], count_prefix: str = "_n_"
) -> DataFrame:
    """Group by ``keys`` with ``aggs`` and the most frequent ``value``, the smallest on ties.

    The general mode aggregate keeps a map of values per group, outside generated code, and
    sorts once a task meets many groups. Here listed values are plain counters in one hash
    aggregation. Values outside the list are counted apart from a filtered second scan, which
    adaptive execution drops from the plan when it finds none; the result is the same for any data.
    The counters stay in the result as ``count_prefix`` + value.
    """
    v = F.col(value)
    listed = sorted(listed)
    main = df.groupBy(*keys).agg(*aggs, *[F.count_if(v == x).alias(count_prefix + x) for x in listed])
    unlisted = (
        df.where(v.isNotNull() & ~v.isin(*listed))
        .groupBy(*keys, value)
        .agg(F.count("*").alias("_n"))
        .groupBy(*keys)
        .agg(F.max("_n").alias("_other_n"), F.min(F.struct((-F.col("_n")).alias("n"), v.alias("v")))["v"].alias("_other"))
    )
    counts = [F.col(count_prefix + x) for x in listed]
    top = F.greatest(F.lit(0), *counts)
    best = F.coalesce(*[F.when((c == top) & (c > 0), x) for c, x in zip(counts, listed)])
    other_n = F.coalesce("_other_n", F.lit(0))
    chosen = F.when((other_n > top) | ((other_n == top) & (F.col("_other") < best)), F.col("_other")).otherwise(best)
    return main.join(unlisted, keys, "left").select(*main.columns, chosen.alias(value))
