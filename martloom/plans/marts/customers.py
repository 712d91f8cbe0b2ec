"""Customer marts: payment profile, state summary, repeat behaviour."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.config import INSTALLMENT_BANDS, PAYMENT_TYPES, Config
from martloom.functions.aggregates import exact_mean, exact_sum, first_by, most_frequent, share
from martloom.functions.dates import elapsed_days
from martloom.functions.numbers import band, flag
from martloom.operators.keys import completed
from martloom.operators.quantiles import quantile


def customer_review_scores(orders: DataFrame, customers: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Mean score per customer id, then mean of those per unique customer; all order statuses count."""
    per_id = (
        orders.select("order_id", "customer_id")
        .join(reviewed, "order_id")
        .groupBy("customer_id")
        .agg((F.sum("score_sum") / F.sum("n_reviews")).alias("score"))
    )
    # repeated pairs must not weigh twice; partitioned by the join key, removing them adds no shuffle
    pairs = customers.select("customer_id", "customer_unique_id").repartition("customer_id").dropDuplicates()
    return (
        per_id.join(pairs, "customer_id")
        .groupBy("customer_unique_id")
        .agg(exact_mean("score").alias("avg_review_score"))
    )


def customer_payment_profile(
    orders: DataFrame,
    paid: DataFrame | None,
    customers: DataFrame,
    reviewed: DataFrame,
    cfg: Config = Config(),
    cut: Callable[[DataFrame, str], DataFrame] | None = None,
    facts: DataFrame | None = None,
) -> DataFrame:
    """One row per unique customer with completed orders; high value means spend at or above the quantile.

    ``paid`` and ``reviewed`` are payments and reviews aggregated per order. ``facts``, where they are written already,
    are the orders with their payments and customers (:func:`martloom.plans.marts.orders.order_facts`), instead of ``paid``.

    The spend quantile needs three light passes over the customers. ``cut`` (for example
    :func:`martloom.session.cut`) writes them once, so those passes read one column of a
    table instead of repeating the joins; without it the job stays a single lazy plan.
    """
    if facts is None:
        people = customers.select("customer_id", "customer_unique_id", "customer_state", "customer_city")
        sold = completed(orders).select("order_id", "customer_id").join(paid, "order_id", "left").join(people, "customer_id", "left")
    else:
        sold = completed(facts)
    sales = sold.where("customer_unique_id IS NOT NULL")
    counts = [F.coalesce(F.sum(f"has_{t}"), F.lit(0)).alias(f"{t}_orders") for t in PAYMENT_TYPES]
    profile = sales.groupBy("customer_unique_id").agg(
        first_by("customer_state", "order_id").alias("customer_state"),
        first_by("customer_city", "order_id").alias("customer_city"),
        F.count("order_id").alias("total_orders"),
        F.coalesce(exact_sum("paid"), F.lit(0.0)).alias("total_spend"),
        exact_mean("paid").alias("avg_order_value"),
        F.coalesce(most_frequent("payment_type"), F.lit("unknown")).alias("preferred_payment_type"),
        F.coalesce(F.avg("max_installments"), F.lit(0.0)).alias("avg_installments"),
        *counts,
        F.coalesce(F.max("max_installments"), F.lit(0)).alias("max_installments_used"),
    )
    base = profile.join(customer_review_scores(orders, customers, reviewed), "customer_unique_id", "left")
    base = base.withColumn("avg_review_score", F.coalesce("avg_review_score", F.lit(0.0)))
    if cut is not None:
        base = cut(base, "customer-base")
    threshold = quantile(base, "total_spend", cfg.hvc_quantile, sketch=cfg.quantile_sketch).scalar()
    return base.select(
        "customer_unique_id",
        "customer_state",
        "customer_city",
        "total_orders",
        "total_spend",
        "avg_order_value",
        flag(F.col("total_spend") >= threshold).alias("is_high_value"),
        "preferred_payment_type",
        "avg_installments",
        *[f"{t}_orders" for t in PAYMENT_TYPES],
        "max_installments_used",
        flag(F.col("avg_installments") > cfg.installments_above).alias("uses_installments"),
        "avg_review_score",
        band("max_installments_used", INSTALLMENT_BANDS).alias("installment_bucket"),
    )


def customer_quantiles(profile: DataFrame, cfg: Config = Config()) -> DataFrame:
    """One row: the spend from which a customer is of high value, and the median order value."""
    spend = quantile(profile, "total_spend", cfg.hvc_quantile, name="spend_quantile", sketch=cfg.quantile_sketch)
    return spend.withColumn("median_order_value", quantile(profile, "avg_order_value", 0.5, sketch=cfg.quantile_sketch).scalar())


def geo_payment_summary(profile: DataFrame) -> DataFrame:
    """Per state. The two payment shares are true shares of customers (0..1)."""
    high = F.col("is_high_value") == 1
    return profile.groupBy("customer_state").agg(
        F.count("*").alias("total_customers"),
        F.count_if(high).alias("high_value_customers"),
        exact_sum("total_spend").alias("total_revenue"),
        exact_mean("avg_order_value").alias("avg_order_value"),
        share(F.col("preferred_payment_type") == "credit_card").alias("credit_card_pct"),
        share(F.col("preferred_payment_type") == "boleto").alias("boleto_pct"),
        exact_mean("avg_installments").alias("installment_avg"),
        (
            F.coalesce(exact_sum(F.when(high, F.col("total_spend"))), F.lit(0.0))
            / F.nullif(exact_sum("total_spend"), F.lit(0.0))
        ).alias("high_value_revenue_share"),
    )


def repeat_customer(orders: DataFrame, customers: DataFrame, profile: DataFrame) -> DataFrame:
    """Purchase span per customer. A customer seen in several states keeps the row of the greatest state.

    Orders are aggregated per customer id before the join: one shuffle serves both, and a
    customer with very many orders enters the join as one row.
    """
    per_id = completed(orders).groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.min("order_purchase_timestamp").alias("first_ts"),
        F.max("order_purchase_timestamp").alias("last_ts"),
    )
    per_state = (
        per_id.join(customers.select("customer_id", "customer_unique_id", "customer_state"), "customer_id")
        .where("customer_unique_id IS NOT NULL AND customer_state IS NOT NULL")
        .groupBy("customer_unique_id", "customer_state")
        .agg(F.sum("total_orders").alias("total_orders"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    )
    kept = per_state.groupBy("customer_unique_id").agg(
        F.max(F.struct("customer_state", "total_orders", "first_ts", "last_ts")).alias("k")
    )
    flags = profile.select("customer_unique_id", "is_high_value")
    return kept.join(flags, "customer_unique_id", "left").select(
        "customer_unique_id",
        F.col("k.customer_state").alias("customer_state"),
        F.col("k.total_orders").alias("total_orders"),
        flag(F.col("k.total_orders") > 1).alias("is_repeat_customer"),
        F.to_date("k.first_ts").alias("first_order_date"),
        F.to_date("k.last_ts").alias("last_order_date"),
        F.coalesce(elapsed_days("k.first_ts", "k.last_ts"), F.lit(0)).alias("days_active"),
        F.coalesce("is_high_value", F.lit(0)).alias("is_high_value"),
    )
