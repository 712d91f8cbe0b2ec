"""Lead marts: acquired sellers, funnel by origin, monthly trend, behaviour profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.aggregates import exact_mean, mean_of_positive, most_frequent
from martloom.functions.dates import year_month
from martloom.functions.numbers import blank_to_unknown, half_even
from martloom.operators.keys import exists_flag


def seller_acquisition(deals: DataFrame, mql: DataFrame) -> DataFrame:
    """One row per closed deal with its first contact; blank texts become ``unknown``."""
    joined = deals.join(mql.select("mql_id", "first_contact_date"), "mql_id", "left")
    texts = ["business_segment", "lead_type", "lead_behaviour_profile", "business_type"]
    return joined.select(
        "mql_id",
        "seller_id",
        *[blank_to_unknown(c).alias(c) for c in texts],
        "first_contact_date",
        "won_date",
        F.coalesce(F.date_diff("won_date", "first_contact_date"), F.lit(0)).alias("days_to_close"),
        F.coalesce("declared_monthly_revenue", F.lit(0.0)).alias("declared_monthly_revenue"),
    ).na.fill("", subset=["seller_id"])


def mql_funnel(mql: DataFrame, acquisition: DataFrame) -> DataFrame:
    """Conversion, closing time and dominant segment per origin, in one aggregation."""
    won = acquisition.select("mql_id", "days_to_close", "business_segment")
    leads = mql.select("mql_id", blank_to_unknown("origin").alias("origin")).join(won, "mql_id", "left")
    converted = F.count("days_to_close")
    return leads.groupBy("origin").agg(
        F.count("mql_id").alias("total_leads"),
        converted.alias("converted_leads"),
        half_even(converted / F.count("mql_id") * 100, 2).alias("conversion_rate"),
        mean_of_positive("days_to_close").alias("avg_days_to_close"),
        F.coalesce(most_frequent("business_segment"), F.lit("unknown")).alias("top_business_segment"),
    )


def mql_monthly(mql: DataFrame, acquisition: DataFrame) -> DataFrame:
    leads = exists_flag(mql.select("mql_id", "origin", "first_contact_date"), acquisition, "mql_id", "converted")
    return leads.groupBy(year_month("first_contact_date").alias("year_month"), blank_to_unknown("origin").alias("origin")).agg(
        F.count("mql_id").alias("total_leads"),
        F.sum("converted").alias("converted_leads"),
        half_even(F.sum("converted") / F.count("mql_id") * 100, 2).alias("conversion_rate"),
    )


def lead_behaviour(acquisition: DataFrame) -> DataFrame:
    return acquisition.groupBy("lead_behaviour_profile").agg(
        F.count("mql_id").alias("total_deals"),
        F.avg("days_to_close").alias("avg_days_to_close"),
        exact_mean("declared_monthly_revenue").alias("avg_declared_revenue"),
        most_frequent("business_segment").alias("top_business_segment"),
    )
