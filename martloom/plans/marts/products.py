"""Product marts: category preference of high-value customers, price ranges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.config import PRICE_BANDS
from martloom.functions.aggregates import exact_mean, exact_sum
from martloom.functions.dates import year_month
from martloom.functions.numbers import band
from martloom.operators.keys import completed, may_occur
from martloom.session import input_bytes

#: From so many bytes of orders on the items are thinned before they are joined; fewer orders are broadcast by Spark itself.
_THIN_FROM = 4 << 20


def hv_category_preference(
    detail: DataFrame,
    profile: DataFrame,
    items: DataFrame,
    categories: DataFrame,
    cut: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Item rows and spend per high-value customer and category; an order without items counts once as ``unknown``.

    Orders without items are known from the order detail, so the items join can be an
    inner one, whose both sides may be split when an order id is hot. With ``cut`` the orders are written first, and
    most items of other orders are left out before the join moves them.
    """
    high = profile.where("is_high_value = 1").select("customer_unique_id")
    sales = completed(detail).join(high, "customer_unique_id", "left_semi").select("order_id", "customer_unique_id", "num_items")
    items = items.select("order_id", "product_id", "price")
    if cut is not None:
        sales = cut(sales, "high-value-sales")
        if input_bytes([sales]) >= _THIN_FROM:
            items = may_occur(items, sales.where("num_items > 0"), "order_id")
    bought = (
        sales.where("num_items > 0")
        .select("order_id", "customer_unique_id")
        .join(items, "order_id")
        .join(categories, "product_id", "left")
        .select("customer_unique_id", F.coalesce("product_category_en", F.lit("unknown")).alias("product_category_en"), "price")
    )
    empty = sales.where("num_items = 0").select(
        "customer_unique_id", F.lit("unknown").alias("product_category_en"), F.lit(None).cast("double").alias("price")
    )
    return (
        bought.unionByName(empty)
        .groupBy("customer_unique_id", "product_category_en")
        .agg(F.count("*").alias("order_count"), F.coalesce(exact_sum("price"), F.lit(0.0)).alias("total_spend"))
    )


def product_price_range(items: DataFrame, orders: DataFrame, categories: DataFrame) -> DataFrame:
    """Item rows (not orders) per month, category and price band."""
    sold = (
        items.select("order_id", "product_id", "price")
        .join(completed(orders).select("order_id", year_month("order_purchase_timestamp").alias("year_month")), "order_id")
        .join(categories, "product_id", "left")
    )
    return sold.groupBy(
        "year_month",
        F.coalesce("product_category_en", F.lit("unknown")).alias("product_category_en"),
        band("price", PRICE_BANDS).alias("price_bucket"),
    ).agg(
        F.count("order_id").alias("order_count"),
        exact_sum("price").alias("total_revenue"),
        exact_mean("price").alias("avg_price"),
    )
