"""Ranks, top rows per group, shares of a total and reproducible folds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.numbers import as_col

Cut = Callable[[DataFrame, str], DataFrame]


def rank_rows(df: DataFrame, name: str, order: list[Column]) -> DataFrame:
    """Number all rows 1..n. One task sees every row: only for aggregated reports."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def share_of_total(value) -> Column:
    """Value over the total of its column; for aggregated reports, as :func:`rank_rows`."""
    v = as_col(value)
    return v / F.nullif(F.sum(v).over(Window.partitionBy()), F.lit(0))


def average_percentile_rank(value) -> Column:
    """Rank over n where equal values share the mean of their ranks; for aggregated reports."""
    v = as_col(value)
    peers = F.count("*").over(Window.partitionBy(v))
    rank = F.rank().over(Window.orderBy(v))
    return (rank + (peers - 1) / 2) / F.count("*").over(Window.partitionBy())


def _in_ranges(df: DataFrame, order: list[Column], amount: Column, cut: Cut, name: str) -> tuple[DataFrame, int]:
    """``df`` written in ranges of ``order``, with its range ``_part`` and ``_before``, the total of ``amount`` in those below.

    Also the total of all.

    The totals are one number per range; they come to the driver and back as a small table.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), name)
    sums = sorted((r["_part"], r["n"]) for r in ranged.groupBy("_part").agg(F.sum(amount).alias("n")).collect())
    before, rows = 0, []
    for part, n in sums:
        rows.append((part, before))
        before += n
    starts = spark.createDataFrame(rows or [(0, 0)], "_part int, _before long")
    return ranged.join(starts, "_part"), before


def rank_all(df: DataFrame, name: str, order: list[Column], cut: Cut) -> DataFrame:
    """Number all rows 1..n in ``order``, for any number of rows: ranges of the order are numbered side by side.

    ``order`` should end with a key. Rows that are equal in it are numbered in any order, and lie in one range.
    """
    held, _ = _in_ranges(df, order, F.lit(1), cut, "ranked-rows")
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return held.withColumn(name, F.col("_before") + inside).drop("_part", "_before")


def percentile_rank_all(df: DataFrame, value: str, name: str, cut: Cut) -> DataFrame:
    """Rank over n where equal values share the mean of their ranks, for any number of rows; NULL for a missing value.

    Equal values are one row while ranks are found, so ties never lie on both sides of a range's border.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_c"))
    held, n = _in_ranges(counts, [F.asc(value)], F.col("_c"), cut, "ranked-values")
    upto = F.sum("_c").over(Window.partitionBy("_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    below = held.withColumn("_below", F.col("_before") + upto - F.col("_c"))
    ranks = below.select(F.col(value).alias("_v"), ((F.col("_below") + (F.col("_c") + 1) / 2) / F.lit(max(n, 1))).alias(name))
    return df.join(ranks, F.col(value) == F.col("_v"), "left").drop("_v")


def top_n_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows per group; the limit is also applied before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def hash_text(key, seed: int) -> Column:
    """Uniform hexadecimal text per key, the same in every engine."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), as_col(key).cast("string")))


def hash_fold(key, folds: int, seed: int) -> Column:
    """Cross-validation fold 0..folds-1 from the key alone: stable under retries and repartitioning."""
    head = F.conv(F.substring(hash_text(key, seed), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(folds)).cast("int")


def numbered(
    df: DataFrame, key: str, seed: int, name: str, by: list[str] | None = None, digits: int = 3
) -> DataFrame:
    """Number the rows of each (large) group 0..n-1 in the order of their key's hash.

    A window over the whole group would put it into one task. The hash is cut into ranges
    of its first ``digits`` hexadecimal digits, rows are numbered inside a range, and each
    range starts where the ones before it end: 3 digits make 4096 ranges, enough for some
    billions of rows, 4 make 65536. Rows whose ``by`` is NULL form a group of their own.
    ``by`` must name a small set of groups.
    """
    by = by or []
    marked = df.withColumn("_h", hash_text(key, seed)).withColumn("_p", F.substring("_h", 1, digits))
    # at most 16 ** digits ranges per group, whatever the number of rows
    sizes = marked.groupBy(*by, "_p").agg(F.count("*").alias("_c"))
    before = Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(c).alias(f"_by_{c}") for c in by], F.col("_p").alias("_q"), F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_s")
    )
    inside = F.row_number().over(Window.partitionBy(*by, "_p").orderBy("_h", key))
    same = F.col("_p") == F.col("_q")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return (
        marked.join(starts, same)
        .withColumn(name, (F.col("_s") + inside - 1).cast("bigint"))
        .drop("_h", "_p", "_s", "_q", *[f"_by_{c}" for c in by])
    )


def stratified_fold(df: DataFrame, key: str, label: str, folds: int, seed: int, name: str = "fold") -> DataFrame:
    """Folds in which every label is spread evenly, off by at most one row; a missing label is a label, too."""
    out = numbered(df, key, seed, "_row", by=[label])
    return out.withColumn(name, F.pmod(F.col("_row"), F.lit(folds)).cast("int")).drop("_row")
