"""Headline figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.config import Config
from martloom.functions.aggregates import exact_sum
from martloom.operators.quantiles import exact_quantile


def executive_kpis(
    profile: DataFrame, repeat: DataFrame, cfg: Config = Config(), quantiles: DataFrame | None = None
) -> DataFrame:
    """Long table (kpi, segment, value): threshold, high-value share, revenue concentration, repeat rates, spend per order."""
    high = F.col("is_high_value") == 1
    totals = profile.agg(
        F.count_if(high).cast("double").alias("hvc_customers"),
        (F.count_if(high) / F.nullif(F.count("*"), F.lit(0))).alias("hvc_customer_share"),
        exact_sum(F.when(high, F.col("total_spend"))).alias("hvc_revenue"),
        exact_sum("total_spend").alias("total_revenue"),
    ).withColumn("hvc_revenue_share", F.col("hvc_revenue") / F.nullif("total_revenue", F.lit(0.0)))
    overall = totals.unpivot([], totals.columns, "kpi", "value").select("kpi", F.lit("all").alias("segment"), "value")
    found = (
        exact_quantile(profile, "total_spend", cfg.hvc_quantile, name="value")
        if quantiles is None
        else quantiles.select(F.col("spend_quantile").alias("value"))
    )
    threshold = found.select(
        F.lit("hvc_spend_threshold").alias("kpi"), F.lit("all").alias("segment"), "value"
    )
    repeats = repeat.groupBy(F.when(high, "high_value").otherwise("regular").alias("segment")).agg(
        F.avg("is_repeat_customer").alias("value")
    ).select(F.lit("repeat_customer_rate").alias("kpi"), "segment", "value")
    spend = profile.groupBy(F.col("installment_bucket").alias("segment")).agg(
        (exact_sum("total_spend") / F.nullif(F.sum("total_orders"), F.lit(0))).alias("value")
    ).select(F.lit("spend_per_order").alias("kpi"), "segment", "value")
    return reduce(DataFrame.unionByName, [threshold, overall, repeats, spend])
