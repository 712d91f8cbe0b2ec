"""Smoothed target encoding, also out of fold, from grouped sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _smoothed(total, count, mean, smoothing):
    return (total + mean * smoothing) / (count + smoothing)


def target_mapping(df: DataFrame, columns: list[str], target: str, smoothing: float) -> DataFrame:
    """One row per (feature, category) with the smoothed mean of the target."""
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("category")) for c in columns]
    per_category = (
        df.select(target, F.inline(F.array(*pairs)))
        .groupBy("feature", "category")
        .agg(F.sum(target).alias("_s"), F.count(target).alias("row_count"))
    )
    mean = df.agg(F.avg(target)).scalar()
    return per_category.select(
        "feature",
        "category",
        "row_count",
        _smoothed(F.col("_s"), F.col("row_count"), mean, F.lit(smoothing)).alias("encoded"),
    )


def encode_out_of_fold(
    df: DataFrame, columns: list[str], target: str, fold: str, smoothing: float, suffix: str = "_enc"
) -> DataFrame:
    """Encode each category by the rows of all other folds: category totals minus the row's own fold.

    ``df`` is read twice: give a table, not a long plan. One pass sums all columns per (feature, category, fold);
    the sums are one small row per feature, a map from (category, fold) to the encoding, which every task reads as a
    constant, so the rows themselves are never shuffled and a category with most of them costs no more than a rare
    one. The columns must be categories in the strict sense: their values times folds is what the maps hold.
    """
    mean = df.agg(F.avg(target)).scalar()
    pairs = [F.struct(F.lit(c).alias("_f"), F.col(c).cast("string").alias("_c")) for c in columns]
    per_fold = (
        df.select(target, fold, F.inline(F.array(*pairs)))
        .groupBy("_f", "_c", fold)
        .agg(F.sum(target).alias("_fs"), F.count(target).alias("_fn"))
    )
    category = Window.partitionBy("_f", "_c")
    totals = per_fold.withColumns({"_ts": F.sum("_fs").over(category), "_tn": F.sum("_fn").over(category)})
    others = totals.where("_tn > _fn AND _c IS NOT NULL").select(
        "_f",
        F.struct("_c", F.col(fold).alias("_fold")).alias("key"),
        _smoothed(
            F.col("_ts") - F.coalesce("_fs", F.lit(0)), F.col("_tn") - F.col("_fn"), mean, F.lit(smoothing)
        ).alias("value"),
    )
    maps = others.groupBy().agg(
        *[
            F.map_from_entries(F.collect_list(F.when(F.col("_f") == c, F.struct("key", "value")))).alias(f"_m{i}")
            for i, c in enumerate(columns)
        ]
    )
    # one row, held once per task
    encodings = maps.select(F.struct("*").alias("_maps")).scalar()
    out = df.withColumn("_maps", encodings)
    for i, c in enumerate(columns):
        key = F.struct(F.col(c).cast("string").alias("_c"), F.col(fold).alias("_fold"))
        out = out.withColumn(c + suffix, F.coalesce(F.try_element_at(F.col("_maps")[f"_m{i}"], key), mean))
    return out.drop("_maps")


def apply_mapping(df: DataFrame, mapping: DataFrame, columns: list[str], mean, suffix: str = "_enc") -> DataFrame:
    """Encode with a stored mapping; categories it does not know get the overall mean."""
    out = df
    for c in columns:
        one = mapping.where(F.col("feature") == c).select(F.col("category").alias(c), F.col("encoded").alias(c + suffix))
        out = out.join(one, c, "left").withColumn(c + suffix, F.coalesce(F.col(c + suffix), mean))
    return out
