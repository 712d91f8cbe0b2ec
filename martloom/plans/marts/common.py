"""Order-level pieces several marts share. All of them aggregate before they join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.config import PAYMENT_TYPES
from martloom.functions.aggregates import exact_sum
from martloom.operators.modes import group_with_mode


def payments_by_order(payments: DataFrame) -> DataFrame:
    """Paid value, dominant type, longest plan and a 0/1 flag per type; consumers prune what they skip."""
    counted = group_with_mode(
        payments,
        ["order_id"],
        "payment_type",
        [*PAYMENT_TYPES, "not_defined"],
        [
            F.coalesce(exact_sum("payment_value"), F.lit(0.0)).alias("paid"),
            F.max("payment_installments").alias("max_installments"),
        ],
        "n_",
    )
    flags = [(F.col(f"n_{t}") > 0).cast("int").alias(f"has_{t}") for t in PAYMENT_TYPES]
    return counted.select("order_id", "paid", "payment_type", "max_installments", *flags)


def reviews_by_order(reviews: DataFrame) -> DataFrame:
    """Counts and sums per order, so a fan-out over single reviews is never needed."""
    score = F.coalesce(F.col("review_score"), F.lit(0))
    return reviews.groupBy("order_id").agg(
        F.count("*").alias("n_reviews"),
        F.sum(score).alias("score_sum"),
        F.count_if(score == 5).alias("n_5star"),
        F.count_if(score == 1).alias("n_1star"),
    )


def product_categories(products: DataFrame, translation: DataFrame) -> DataFrame:
    """English category per product, else the original name, else ``unknown``.

    The translation table is tiny, but no hint is given: the size check that decides on
    broadcasting it is Spark's own.
    """
    t = translation.select("product_category_name", F.col("product_category_name_english").alias("_en"))
    return products.join(t, "product_category_name", "left").select(
        "product_id",
        F.coalesce(
            F.when(F.col("_en") != "", F.col("_en")),
            F.when(F.col("product_category_name") != "", F.col("product_category_name")),
            F.lit("unknown"),
        ).alias("product_category_en"),
    )
