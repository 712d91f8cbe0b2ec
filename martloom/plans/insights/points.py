"""Loyalty points and tiers for customers and sellers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.config import (
    AD_CREDIT_SHARE,
    CATEGORY_MULTIPLIER,
    FRONTIER_MULTIPLIER,
    INSTALLMENT_MULTIPLIERS,
    REVIEW_BONUS,
    SELLER_AD_PACKAGES,
    SELLER_VALUE_MULTIPLIER,
    Config,
)
from martloom.functions.aggregates import exact_mean
from martloom.functions.numbers import band, half_even, lookup, tier
from martloom.operators.dense import dense_levels
from martloom.operators.keys import exists_flag
from martloom.operators.ranking import share_of_total


def _next_tiers(tiers) -> tuple[dict, dict]:
    """Tier -> next tier, and tier -> upper bound (its own edge at the top)."""
    ladder = sorted(tiers)
    above = ladder[1:] + ladder[-1:]
    names = {label: up[1] for (_, label), up in zip(ladder, above)}
    bounds = {label: float(up[0]) for (_, label), up in zip(ladder, above)}
    return names, bounds


def _with_progress(df: DataFrame, tiers) -> DataFrame:
    """Tier, next tier and missing points.

    The missing points are measured against the upper bound of the *next* tier, so a Bronze
    customer is shown the distance to the end of Silver. Published results depend on it.
    """
    names, bounds = _next_tiers(tiers)
    return (
        df.withColumn("tier", tier("total_points", tiers))
        .withColumn("next_tier", lookup("tier", names))
        .withColumn("points_to_next", F.rint(F.greatest(lookup("next_tier", bounds) - F.col("total_points"), F.lit(0.0))))
    )


def checkout_audience(high: Column, repeat: Column, bucket: Column) -> Column:
    """Audience of the points programme: regular customers split by installment use."""
    return (
        F.when((high == 1) & (repeat == 1), "HVC Loyal")
        .when((high == 1) & (repeat == 0), "HVC One-Time")
        .when((high == 0) & (bucket != "1"), "RC Upgrade Path")
        .otherwise("RC Single-Pay")
    )


def customer_points(profile: DataFrame, hv_category: DataFrame, repeat: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Points per customer: spend times installment, category and state multipliers, plus a review bonus."""
    fans = hv_category.where(F.col("product_category_en").isin(*cfg.top_categories))
    base = exists_flag(
        profile.select(
            "customer_unique_id",
            "customer_state",
            "customer_city",
            "total_spend",
            "is_high_value",
            "preferred_payment_type",
            "installment_bucket",
            "max_installments_used",
            "uses_installments",
            "avg_review_score",
            "total_orders",
        ),
        fans,
        "customer_unique_id",
        "_fan",
    )
    reviewed = (F.col("avg_review_score") > 0) & (F.col("total_orders") >= 1)
    earned = base.withColumns(
        {
            "base_points": half_even("total_spend", 2),
            "installment_mult": lookup("installment_bucket", INSTALLMENT_MULTIPLIERS, 1.0),
            "category_mult": F.when(F.col("_fan") == 1, CATEGORY_MULTIPLIER).otherwise(1.0),
            "frontier_mult": F.when(F.col("customer_state").isin(*cfg.frontier_states), FRONTIER_MULTIPLIER).otherwise(1.0),
            "review_bonus": F.when(reviewed, REVIEW_BONUS).otherwise(0),
        }
    ).drop("_fan")
    product = F.col("base_points") * F.col("installment_mult") * F.col("category_mult") * F.col("frontier_mult")
    scored = _with_progress(earned.withColumn("total_points", F.rint(product + F.col("review_bonus"))), cfg.customer_tiers)
    return (
        scored.join(repeat.select("customer_unique_id", "is_repeat_customer"), "customer_unique_id", "left")
        .withColumn("is_repeat_customer", F.coalesce("is_repeat_customer", F.lit(0)))
        .withColumn(
            "marketing_audience",
            checkout_audience(F.col("is_high_value"), F.col("is_repeat_customer"), F.col("installment_bucket")),
        )
    )


def seller_points(performance: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Points per seller from reviews and volume, with revenue tier, advertising package and credit."""
    bonus = F.when(F.col("avg_order_value") > cfg.hvc_spend_threshold, SELLER_VALUE_MULTIPLIER).otherwise(1.0)
    earned = (
        performance.withColumn("base_points", F.rint(F.col("avg_review_score") * 100 * F.col("total_orders")))
        .withColumn("category_bonus", bonus)
        .withColumn("total_points", F.rint(F.col("base_points") * F.col("category_bonus")))
        .withColumn("revenue_tier", band("total_revenue", cfg.seller_revenue_bands))
        .withColumn("ad_package", lookup("revenue_tier", SELLER_AD_PACKAGES))
        .withColumn("ad_credit_value", half_even(F.col("total_points") * AD_CREDIT_SHARE, 2))
    )
    return _with_progress(earned, cfg.seller_tiers)


def tier_summary(customers: DataFrame, sellers: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Both programmes per tier; all tiers are listed, also empty ones."""
    c = customers.groupBy("tier").agg(
        F.count("*").alias("c_n"), F.avg("total_points").alias("c_points"), F.avg("is_high_value").alias("c_high")
    )
    s = sellers.groupBy("tier").agg(
        F.count("*").alias("s_n"), F.avg("total_points").alias("s_points"), exact_mean("ad_credit_value").alias("s_credit")
    )
    rows = dense_levels(c.join(s, "tier", "full"), "tier", [label for _, label in cfg.customer_tiers])
    zero = F.lit(0.0)
    return rows.na.fill(0, subset=["c_n", "s_n"]).select(
        "tier",
        F.col("c_n").alias("customer_count"),
        F.coalesce(half_even(share_of_total("c_n") * 100, 1), zero).alias("customer_pct"),
        F.coalesce(half_even("c_points", 0), zero).alias("avg_customer_points"),
        F.coalesce(half_even(F.col("c_high") * 100, 1), zero).alias("hvc_in_tier_pct"),
        F.col("s_n").alias("seller_count"),
        F.coalesce(half_even(share_of_total("s_n") * 100, 1), zero).alias("seller_pct"),
        F.coalesce(half_even("s_points", 0), zero).alias("avg_seller_points"),
        F.coalesce(half_even("s_credit", 2), zero).alias("avg_seller_ad_credit"),
    )


def installment_impact(points: DataFrame) -> DataFrame:
    return points.groupBy("installment_bucket").agg(
        F.count("customer_unique_id").alias("customers"),
        half_even(exact_mean("base_points"), 1).alias("avg_base_points"),
        half_even(F.avg("total_points"), 1).alias("avg_total_points"),
    )


def audience_distribution(points: DataFrame) -> DataFrame:
    counts = points.groupBy("marketing_audience").agg(F.count("*").alias("customer_count"))
    return counts.withColumn("pct", half_even(share_of_total("customer_count") * 100, 1))
