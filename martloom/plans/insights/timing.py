"""Campaign timing from monthly revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.config import (
    FLASH_CHANNELS,
    FLASH_SCORE,
    FLASH_TYPES,
    FLASH_WINDOWS,
    INTENSITY_TIERS,
    LAUNCH_DAYS,
    MAJOR_FLASH_SCORE,
    SEASONAL_EVENTS,
    Config,
)
from martloom.functions.aggregates import exact_mean, exact_sum
from martloom.functions.dates import month_name, month_of
from martloom.functions.numbers import half_even, lookup, tier
from martloom.operators.dense import dense_levels
from martloom.operators.ranking import average_percentile_rank, share_of_total, top_n_per_group


def _tenths(value):
    """One-decimal scores as integers: their sums are exact, so rounding ties cannot drift."""
    return F.rint(F.col(value) * 10).cast("bigint")


def campaign_calendar(monthly: DataFrame) -> DataFrame:
    """Intensity 1..10 per observed month by percentile rank, averaged into a twelve-month calendar."""
    months = monthly.groupBy("year_month").agg(
        exact_sum("total_revenue").alias("total_revenue"), F.sum("order_count").alias("order_count")
    )
    scored = months.select(
        month_of("year_month").alias("calendar_month"),
        "total_revenue",
        "order_count",
        half_even(average_percentile_rank("total_revenue") * 9 + 1, 1).alias("month_score"),
    )
    calendar = scored.groupBy("calendar_month").agg(
        half_even(exact_mean("total_revenue"), 0).alias("avg_revenue"),
        half_even(F.sum("order_count") / F.count("*"), 0).alias("avg_orders"),
        half_even(F.sum(_tenths("month_score")) / (F.count("*") * 10), 1).alias("intensity_score"),
        F.count("*").alias("data_points"),
    )
    score = F.col("intensity_score")
    return calendar.withColumn("intensity_band", tier(score, INTENSITY_TIERS)).select(
        "calendar_month",
        month_name("calendar_month").alias("month_name"),
        "intensity_score",
        "intensity_band",
        lookup("calendar_month", SEASONAL_EVENTS).alias("seasonal_event"),
        lookup("intensity_band", LAUNCH_DAYS).alias("pre_launch_days"),
        (score >= FLASH_SCORE).alias("flash_sale_flag"),
        "avg_revenue",
        "avg_orders",
        half_even(share_of_total(_tenths("intensity_score")) * 100, 1).alias("campaign_budget_weight"),
        "data_points",
    )


def category_timing(price_range: DataFrame, cfg: Config = Config()) -> DataFrame:
    """The three best months of each top category."""
    by_month = (
        price_range.where(F.col("product_category_en").isin(*cfg.top_categories))
        .groupBy(F.col("product_category_en").alias("category"), month_of("year_month").alias("m"))
        .agg(exact_sum("total_revenue").alias("revenue"))
    )
    best = top_n_per_group(by_month, ["category"], [F.desc("revenue"), F.asc("m")], 3)
    # at most three entries per category
    peaks = best.groupBy("category").agg(
        F.array_sort(F.collect_list(F.struct("rank", "m", "revenue"))).alias("p")
    )
    numbers = F.transform("p", lambda x: x["m"])
    return peaks.select(
        "category",
        F.array_join(F.transform(numbers, lambda m: month_name(m)), ", ").alias("peak_months"),
        numbers.alias("peak_month_nums"),
        half_even(F.col("p")[0]["revenue"], 0).alias("top_month_revenue"),
        month_name(F.col("p")[0]["m"]).alias("top_month"),
        lookup(F.col("p")[0]["m"], SEASONAL_EVENTS).alias("seasonal_event"),
    )


def flash_sale_windows(calendar: DataFrame) -> DataFrame:
    major = F.col("intensity_score") >= MAJOR_FLASH_SCORE
    return calendar.where("flash_sale_flag").select(
        "calendar_month",
        "month_name",
        "intensity_score",
        "seasonal_event",
        F.when(major, FLASH_TYPES[0]).otherwise(FLASH_TYPES[1]).alias("flash_sale_type"),
        lookup("intensity_band", FLASH_WINDOWS).alias("recommended_window"),
        F.when(major, FLASH_CHANNELS[0]).otherwise(FLASH_CHANNELS[1]).alias("channel_priority"),
        "campaign_budget_weight",
    )


def campaign_band_budget(calendar: DataFrame) -> DataFrame:
    """Months and budget share per intensity band; the calendar has twelve rows at most."""
    bands = calendar.groupBy("intensity_band").agg(
        F.count("*").alias("n"),
        (F.sum(_tenths("campaign_budget_weight")) / 10.0).alias("budget"),
        F.array_sort(F.collect_list(F.struct("calendar_month", "month_name"))).alias("m"),
    )
    return dense_levels(bands, "intensity_band", ["HIGH", "MEDIUM", "LOW"]).select(
        "intensity_band",
        F.coalesce("n", F.lit(0)).alias("month_count"),
        F.coalesce("budget", F.lit(0.0)).alias("budget_pct"),
        F.coalesce(F.array_join(F.transform("m", lambda x: x["month_name"]), ", "), F.lit("")).alias("months"),
    )
