"""Reports that must show every level of a fixed list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dense_levels(df: DataFrame, name: str, levels: list[str]) -> DataFrame:
    """One row per level in list order (column ``level_order``); levels without data get NULLs."""
    rows = [F.struct(F.lit(level).alias(name), F.lit(i + 1).alias("level_order")) for i, level in enumerate(levels)]
    # as expressions, since rows from a Python list start a Python worker on every core
    fixed = df.sparkSession.range(1, numPartitions=1).select(F.inline(F.array(*rows)))
    return fixed.join(df, name, "left")
