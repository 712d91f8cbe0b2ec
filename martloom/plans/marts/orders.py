"""Order marts: payment detail, monthly revenue, payment leakage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.aggregates import decimal_sum, exact_mean, exact_sum
from martloom.functions.dates import year_month
from martloom.operators.keys import completed


def order_facts(orders: DataFrame, paid: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """Orders of any status with their payments, items and customer, as they are; NULL where there are none.

    Payments (``paid``) and items are aggregated per order first, so the three-way join on
    the order id shuffles the orders once and nothing fans out; the customer lookup comes last.
    """
    bought = items.groupBy("order_id").agg(
        F.count("*").alias("num_items"), exact_sum(F.col("price") + F.col("freight_value")).alias("total_order_value")
    )
    return (
        orders.select("order_id", "customer_id", "order_status", "order_purchase_timestamp")
        .join(paid, "order_id", "left")
        .join(bought, "order_id", "left")
        .join(customers, "customer_id", "left")
        .drop("customer_id")
    )


def order_payment_detail(orders: DataFrame, paid: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """One row per order, whatever its status."""
    paid = paid.select("order_id", "paid", "payment_type", "max_installments")
    return detail_of(order_facts(orders, paid, customers.select("customer_id", "customer_unique_id", "customer_state"), items))


def detail_of(facts: DataFrame) -> DataFrame:
    """The order mart from :func:`order_facts`."""
    return facts.select(
        "order_id",
        "customer_unique_id",
        "customer_state",
        "order_status",
        "order_purchase_timestamp",
        F.coalesce("total_order_value", F.lit(0.0)).alias("total_order_value"),
        F.coalesce("paid", F.lit(0.0)).alias("total_payment_value"),
        F.coalesce("payment_type", F.lit("unknown")).alias("payment_type"),
        F.coalesce("max_installments", F.lit(0)).alias("payment_installments"),
        F.coalesce("num_items", F.lit(0)).cast("int").alias("num_items"),
        F.lit("").alias("product_categories"),
    ).na.fill("", subset=["customer_unique_id", "customer_state"])


def monthly_revenue(detail: DataFrame) -> DataFrame:
    sold = completed(detail).where("payment_type <> ''")
    return sold.groupBy(year_month("order_purchase_timestamp").alias("year_month"), "payment_type").agg(
        F.count("total_payment_value").alias("order_count"),
        exact_sum("total_payment_value").alias("total_revenue"),
        exact_mean("total_payment_value").alias("avg_order_value"),
    )


def payment_leakage(detail: DataFrame, analysis_date: Column | None = None) -> DataFrame:
    """How far each state and payment type stays below the national mean order value, times its volume.

    The national mean comes from the group totals, so the orders are read once.
    """
    groups = detail.groupBy("customer_state", "payment_type").agg(
        F.count("total_payment_value").alias("order_count"), decimal_sum("total_payment_value").alias("_total")
    )
    everything = Window.partitionBy()
    national = F.sum("_total").over(everything).cast("double") / F.sum("order_count").over(everything)
    scored = groups.select(
        "customer_state",
        "payment_type",
        "order_count",
        (F.col("_total").cast("double") / F.col("order_count")).alias("avg_value"),
        national.alias("national_avg"),
    )
    gap = (F.col("national_avg") - F.col("avg_value")) / F.nullif("national_avg", F.lit(0.0))
    return scored.select(
        (F.current_date() if analysis_date is None else analysis_date).alias("analysis_date"),
        F.col("customer_state").alias("state"),
        "payment_type",
        "order_count",
        "avg_value",
        F.greatest(gap * F.col("order_count"), F.lit(0.0)).alias("leakage_score"),
    )
