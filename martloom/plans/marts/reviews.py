"""Review mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import elapsed_days
from martloom.functions.numbers import flag


def review_by_segment(
    orders: DataFrame, customers: DataFrame, reviewed: DataFrame, paid: DataFrame, profile: DataFrame
) -> DataFrame:
    """Scores and delivery per value flag, payment type and state, over all order statuses.

    An order with several reviews counts once per review, one without a review counts once
    with score 0. Reviews are counted per order before the join and used as weights, which
    gives the same means as joining every review.
    """
    weight = F.greatest(F.coalesce("n_reviews", F.lit(0)), F.lit(1))
    days = F.coalesce(elapsed_days("order_purchase_timestamp", "order_delivered_customer_date"), F.lit(0))
    late = flag(F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"))
    facts = (
        orders.select("order_id", "customer_id", days.alias("days"), late.alias("late"))
        .join(reviewed, "order_id", "left")
        .join(paid.select("order_id", "payment_type"), "order_id", "left")
        .join(customers.select("customer_id", "customer_unique_id", "customer_state"), "customer_id")
        .join(profile.select("customer_unique_id", "is_high_value"), "customer_unique_id", "left")
    )
    total = F.sum("w")

    def weighted(column: str):
        return F.sum(F.coalesce(F.col(column), F.lit(0))) / total

    return (
        facts.withColumn("w", weight)
        .withColumn("days_w", F.col("days") * F.col("w"))
        .withColumn("late_w", F.col("late") * F.col("w"))
        .where("customer_state IS NOT NULL")
        .groupBy(
            F.coalesce("is_high_value", F.lit(0)).alias("is_high_value"),
            F.coalesce("payment_type", F.lit("unknown")).alias("payment_type"),
            "customer_state",
        )
        .agg(
            weighted("score_sum").alias("avg_review_score"),
            total.alias("total_reviews"),
            (weighted("n_5star") * 100).alias("pct_5star"),
            (weighted("n_1star") * 100).alias("pct_1star"),
            weighted("days_w").alias("avg_delivery_days"),
            weighted("late_w").alias("late_delivery_rate"),
        )
    )
