"""Lead channels, behaviour profiles and segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.config import (
    CHANNEL_FIX_TRACKING,
    CHANNEL_INCREASE,
    CHANNEL_MAINTAIN,
    CHANNEL_PAUSE,
    CHANNEL_PRIORITIES,
    CHANNEL_REDUCE,
    CLOSE_TIME_PACKAGES,
    DEFAULT_ONBOARDING,
    ONBOARDING_PACKAGES,
)
from martloom.functions.aggregates import pct
from martloom.functions.numbers import blank_to_unknown, half_even, lookup
from martloom.operators.keys import exists_flag
from martloom.operators.ranking import rank_rows, share_of_total


def channel_efficiency(mql: DataFrame, acquisition: DataFrame) -> DataFrame:
    """Conversion weighted by log volume per origin, ranked, with budget share and action."""
    leads = exists_flag(mql.select("mql_id", blank_to_unknown("origin").alias("origin")), acquisition, "mql_id", "converted")
    totals = leads.groupBy("origin").agg(
        F.count("mql_id").alias("total_leads"), F.sum("converted").alias("converted_leads")
    )
    rate = F.col("converted_leads") / F.col("total_leads")
    scored = totals.withColumns(
        {"conversion_rate_pct": half_even(rate * 100, 2), "log_volume": half_even(F.log(F.col("total_leads") + 1), 4)}
    ).withColumn("efficiency_score", half_even(rate * F.col("log_volume"), 6))
    ranked = rank_rows(scored, "rank", [F.desc("efficiency_score"), F.asc("origin")])
    unknown, rank = F.col("origin") == "unknown", F.col("rank")
    p0, p1, p2, p3 = CHANNEL_PRIORITIES
    return ranked.withColumns(
        {
            "budget_allocation_pct": half_even(share_of_total("efficiency_score") * 100, 1),
            "action_priority": F.when(unknown, p0).when(rank <= 2, p1).when(rank <= 4, p2).otherwise(p3),
            "recommendation": F.when(unknown, CHANNEL_FIX_TRACKING)
            .when(F.col("efficiency_score") == 0, CHANNEL_PAUSE)
            .when(rank <= 2, F.format_string(CHANNEL_INCREASE, rank))
            .when(rank <= 4, CHANNEL_MAINTAIN)
            .otherwise(CHANNEL_REDUCE),
        }
    )


def _known_profiles(acquisition: DataFrame) -> DataFrame:
    # deals without a profile or segment are no group of their own in these reports
    return acquisition.where("lead_behaviour_profile <> 'unknown'")


def profile_close_time(acquisition: DataFrame) -> DataFrame:
    """Days to close per behaviour profile. Days are whole numbers, so the median's buffer stays small."""
    days = F.col("days_to_close")
    fast, standard, intensive = CLOSE_TIME_PACKAGES
    stats = _known_profiles(acquisition).groupBy("lead_behaviour_profile").agg(
        F.count("seller_id").alias("seller_count"),
        half_even(F.avg(days), 1).alias("avg_days_to_close"),
        half_even(F.median(days), 1).alias("median_days_to_close"),
        F.min(days).alias("min_days"),
        F.max(days).alias("max_days"),
    )
    avg = F.col("avg_days_to_close")
    return stats.withColumn("onboarding_package", F.when(avg < 45, fast).when(avg < 90, standard).otherwise(intensive))


def segment_distribution(acquisition: DataFrame) -> DataFrame:
    stats = acquisition.where("business_segment <> 'unknown'").groupBy("business_segment").agg(
        F.count("seller_id").alias("converted_count"),
        half_even(F.avg("days_to_close"), 1).alias("avg_days"),
        half_even(pct(F.col("business_type") == "reseller"), 1).alias("pct_resellers"),
    )
    return stats.withColumn("platform_share_pct", half_even(share_of_total("converted_count") * 100, 1))


def profile_onboarding_packages(acquisition: DataFrame) -> DataFrame:
    stats = _known_profiles(acquisition).groupBy("lead_behaviour_profile").agg(
        F.count("seller_id").alias("count"), half_even(F.avg("days_to_close"), 1).alias("avg_days")
    )
    return stats.withColumn(
        "onboarding_package", lookup("lead_behaviour_profile", ONBOARDING_PACKAGES, DEFAULT_ONBOARDING)
    )
