"""Seller mart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.aggregates import decimal_sum
from martloom.functions.dates import year_month
from martloom.operators.keys import completed
from martloom.operators.sketches import LOG_VALUES, distinct_counts, distinct_sketches


def sold_items(items: DataFrame, orders: DataFrame, reviewed: DataFrame, categories: DataFrame) -> DataFrame:
    """Items of completed orders with seller, price, review mean of the order (a missing review is 0), category and time."""
    scored = (
        completed(orders)
        .select("order_id", "order_purchase_timestamp")
        .join(reviewed.select("order_id", (F.col("score_sum") / F.col("n_reviews")).alias("score")), "order_id", "left")
    )
    return (
        items.where("seller_id IS NOT NULL")
        .select("order_id", "seller_id", "product_id", "price")
        .join(scored, "order_id")
        .join(categories, "product_id", "left")
        .select(
            "seller_id",
            "order_id",
            "price",
            F.coalesce("score", F.lit(0.0)).alias("score"),
            F.coalesce("product_category_en", F.lit("unknown")).alias("category"),
            "order_purchase_timestamp",
        )
    )


def seller_month_sketches(sold: DataFrame, log_values: int = LOG_VALUES) -> DataFrame:
    """Distinct orders and categories per month and seller as sketches, to be kept and merged."""
    dated = sold.withColumn("year_month", year_month("order_purchase_timestamp"))
    return distinct_sketches(dated, ["order_id", "category"], ["year_month", "seller_id"], log_values)


def seller_breadth(sketches: DataFrame, log_values: int = LOG_VALUES) -> DataFrame:
    """Distinct orders and categories per seller over the months of ``sketches``, without their items."""
    return distinct_counts(sketches, {"order_id": "total_orders", "category": "unique_categories"}, ["seller_id"], log_values)


def seller_performance(
    items: DataFrame,
    orders: DataFrame,
    sellers: DataFrame,
    reviewed: DataFrame,
    categories: DataFrame,
    cut: Callable[[DataFrame, str], DataFrame] | None = None,
    sketch: int | None = None,
) -> DataFrame:
    """Orders, revenue, mean item price, review mean (a missing review counts 0) and breadth per seller.

    Completed orders and their review mean are put together first, so the items meet one
    order-level side instead of two. The sold items are aggregated once per (seller, order) and once per
    (seller, category): two distinct counts in one aggregation would triple the rows before the shuffle. ``cut`` writes
    the sold items once for both. The seller's own columns join after the aggregation.

    ``sketch``: orders and categories are counted by distinct sketches of that size (a binary logarithm) instead, in the one
    aggregation of the amounts.
    """
    sold = sold_items(items, orders, reviewed, categories)
    if cut is not None:
        sold = cut(sold, "sold-items")
    if sketch is not None:
        return _named(_sketched(sold, sketch), sellers)
    per_order = sold.groupBy("seller_id", "order_id").agg(
        F.count("price").alias("_priced"),
        F.count("*").alias("_items"),
        decimal_sum("price").alias("_price"),
        decimal_sum("score").alias("_score"),
    )
    revenue, points = F.sum("_price").cast("double"), F.sum("_score").cast("double")
    per_seller = per_order.groupBy("seller_id").agg(
        F.count("*").alias("total_orders"),
        F.coalesce(revenue, F.lit(0.0)).alias("total_revenue"),
        (revenue / F.nullif(F.sum("_priced"), F.lit(0))).alias("avg_order_value"),
        (points / F.sum("_items")).alias("avg_review_score"),
        F.sum("_priced").alias("total_items_sold"),
    )
    breadth = sold.select("seller_id", "category").distinct().groupBy("seller_id").agg(F.count("*").alias("unique_categories"))
    return _named(per_seller.join(breadth, "seller_id"), sellers)


def _sketched(sold: DataFrame, sketch: int) -> DataFrame:
    def distinct(column: str) -> Column:
        return F.theta_sketch_estimate(F.theta_sketch_agg(column, sketch))

    revenue = decimal_sum("price").cast("double")
    return sold.groupBy("seller_id").agg(
        distinct("order_id").alias("total_orders"),
        F.coalesce(revenue, F.lit(0.0)).alias("total_revenue"),
        (revenue / F.nullif(F.count("price"), F.lit(0))).alias("avg_order_value"),
        (decimal_sum("score").cast("double") / F.count("*")).alias("avg_review_score"),
        F.count("price").alias("total_items_sold"),
        distinct("category").alias("unique_categories"),
    )


def _named(per_seller: DataFrame, sellers: DataFrame) -> DataFrame:
    named = sellers.select("seller_id", "seller_state", "seller_city")
    return per_seller.join(named, "seller_id", "left").select(
        "seller_id",
        F.coalesce("seller_state", F.lit("")).alias("seller_state"),
        F.coalesce("seller_city", F.lit("")).alias("seller_city"),
        "total_orders",
        "total_revenue",
        "avg_order_value",
        "avg_review_score",
        "unique_categories",
        "total_items_sold",
    )
