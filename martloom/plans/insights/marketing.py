"""Trigger and audience segmentation of customers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.config import AUDIENCE_STRATEGIES, TRIGGER_ACTIONS, TRIGGERS, Config
from martloom.functions.aggregates import exact_mean, pct
from martloom.functions.numbers import flag, half_even, lookup
from martloom.operators.quantiles import exact_quantile


def trigger_segments(
    profile: DataFrame, repeat: DataFrame, cfg: Config = Config(), quantiles: DataFrame | None = None
) -> DataFrame:
    """Five 0/1 triggers per customer, how many are active, and the first active one with its action.

    ``quantiles``: the row of :func:`martloom.plans.marts.customers.customer_quantiles`, if it is at hand.
    """
    facts = profile.join(
        repeat.select("customer_unique_id", "is_repeat_customer", "days_active"), "customer_unique_id", "left"
    )
    median = (
        exact_quantile(profile, "avg_order_value", 0.5) if quantiles is None else quantiles.select("median_order_value")
    ).scalar()
    value, kind = F.col("avg_order_value"), F.col("preferred_payment_type")
    above = value > cfg.hvc_spend_threshold
    conditions = (
        F.col("total_orders") >= 1,
        (kind == "boleto") & above,
        (kind == "voucher") & (value > median),
        (F.col("is_repeat_customer") == 0) & (F.col("days_active") == 0) & (F.col("total_orders") == 1),
        (F.col("is_high_value") == 1) & (F.col("uses_installments") == 0) & above,
    )
    marked = facts.select(
        "customer_unique_id",
        "customer_state",
        "is_high_value",
        "preferred_payment_type",
        "avg_order_value",
        "total_orders",
        *[flag(c).alias(name) for name, c in zip(TRIGGERS, conditions)],
    )
    active = reduce(lambda a, b: a + b, [F.col(t) for t in TRIGGERS])
    primary = F.coalesce(*[F.when(F.col(t) == 1, t) for t in TRIGGERS], F.lit("none"))
    return (
        marked.withColumn("active_triggers", active)
        .withColumn("primary_trigger", primary)
        .withColumn(
            "trigger_action",
            lookup(F.regexp_replace("primary_trigger", "^T[1-5]_", ""), TRIGGER_ACTIONS, "No action"),
        )
    )


def trigger_summary(triggers: DataFrame) -> DataFrame:
    """Customers per trigger, and with at least one or two of them, from a single pass."""
    counts = {t: F.sum(t) for t in TRIGGERS} | {
        "at_least_one": F.count_if(F.col("active_triggers") > 0),
        "at_least_two": F.count_if(F.col("active_triggers") > 1),
    }
    one = triggers.agg(F.count("*").alias("n"), *[F.coalesce(c, F.lit(0)).alias(name) for name, c in counts.items()])
    rows = F.inline(F.array(*[F.struct(F.lit(n).alias("trigger"), F.col(n).alias("customer_count")) for n in counts]))
    return one.select("n", rows).select(
        "trigger", "customer_count", half_even(F.col("customer_count") / F.nullif("n", F.lit(0)) * 100, 1).alias("pct")
    )


def audience_segments(profile: DataFrame, repeat: DataFrame, hv_category: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Exclusive audience by value and repeat purchase, with the customer's top category."""
    top = hv_category.groupBy("customer_unique_id").agg(
        # most spend first, then the alphabetically first category
        F.min_by("product_category_en", F.struct(-F.col("total_spend"), "product_category_en")).alias("top_category")
    )
    facts = profile.join(repeat.select("customer_unique_id", "is_repeat_customer"), "customer_unique_id", "left").join(
        top, "customer_unique_id", "left"
    )
    high, again = F.col("is_high_value"), F.col("is_repeat_customer")
    segment = (
        F.when((high == 1) & (again == 1), "hvc_loyal")
        .when((high == 1) & (again == 0), "hvc_one_time")
        .when((high == 0) & (again == 1), "rc_upgrade_path")
        .otherwise("rc_single_pay")
    )
    return (
        facts.withColumn("top_category", F.coalesce("top_category", F.lit("unknown")))
        .withColumn("is_hvc_category", flag(F.col("top_category").isin(*cfg.top_categories)))
        .withColumn("audience_segment", segment)
        .withColumn("audience_strategy", lookup("audience_segment", AUDIENCE_STRATEGIES))
        .select(
            "customer_unique_id",
            "customer_state",
            "is_high_value",
            "is_repeat_customer",
            "total_spend",
            "avg_order_value",
            "preferred_payment_type",
            "uses_installments",
            "top_category",
            "is_hvc_category",
            "audience_segment",
            "audience_strategy",
        )
    )


def segment_summary(audiences: DataFrame) -> DataFrame:
    stats = audiences.groupBy("audience_segment").agg(
        F.count("customer_unique_id").alias("customer_count"),
        half_even(exact_mean("total_spend"), 0).alias("avg_spend"),
        half_even(exact_mean("avg_order_value"), 1).alias("avg_order_value"),
        half_even(pct(F.col("preferred_payment_type") == "credit_card"), 1).alias("pct_credit_card"),
        half_even(F.avg("uses_installments"), 3).alias("pct_installments"),
        half_even(F.avg("is_hvc_category"), 3).alias("pct_hvc_category"),
    )
    return stats.withColumn("strategy", lookup("audience_segment", AUDIENCE_STRATEGIES))


def hvc_loyal_top_categories(audiences: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most frequent top categories of loyal high-value customers."""
    counts = audiences.where("audience_segment = 'hvc_loyal'").groupBy("top_category").agg(
        F.count("*").alias("customer_count")
    )
    return counts.orderBy(F.desc("customer_count"), F.asc("top_category")).limit(n)
