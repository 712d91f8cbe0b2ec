"""Payment leakage: alerts, state totals, routing failures, check of the national mean."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.config import ALERT_TEXTS, CRITICAL_PAYMENT_TYPES, Config
from martloom.functions.aggregates import exact_mean, exact_sum
from martloom.functions.numbers import half_even, one_decimal, pct_below, tier
from martloom.functions.text import fill
from martloom.operators.ranking import rank_rows


def leakage_alerts(leakage: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Groups with a positive score, worst first, each with severity, money at risk and what to do."""
    national = F.lit(float(cfg.national_avg_order_value))
    rated = leakage.where("leakage_score > 0").withColumns(
        {
            "pct_below_national_avg": pct_below("avg_value", national),
            "severity": tier("leakage_score", cfg.severity_tiers),
            "revenue_at_risk": half_even(
                F.abs(F.least(F.col("avg_value") - national, F.lit(0.0))) * F.col("order_count"), 2
            ),
        }
    )
    state, kind, score, gap = (F.col(c) for c in ("state", "payment_type", "leakage_score", "pct_below_national_avg"))
    named = {
        "state": state,
        "kind": kind,
        "gap": one_decimal(gap),
        "orders": F.format_number("order_count", 0),
        "threshold": f"{cfg.hvc_spend_threshold:.2f}",
    }
    text = {name: fill(template, **named) for name, template in ALERT_TEXTS.items()}
    remedy = (
        F.when(kind.isin(*CRITICAL_PAYMENT_TYPES), text["routing"])
        .when((kind == "credit_card") & (score > cfg.push_plan_score), text["plan"])
        .when((kind == "boleto") & (score > cfg.offer_upgrade_score), text["upgrade"])
        .when(gap > cfg.friction_pct, text["friction"])
        .otherwise(text["watch"])
    )
    alerts = rated.withColumns({"alert_flag": gap > cfg.leakage_alert_pct, "remediation": remedy})
    return rank_rows(alerts, "alert_rank", [F.desc("leakage_score"), F.asc("state"), F.asc("payment_type")])


def leakage_state_summary(alerts: DataFrame) -> DataFrame:
    totals = alerts.groupBy("state").agg(
        exact_sum("leakage_score").alias("total_leakage_score"),
        F.sum("order_count").alias("total_orders_affected"),
        exact_sum("revenue_at_risk").alias("total_revenue_at_risk"),
        F.count("payment_type").alias("num_payment_types"),
        F.min_by("payment_type", "alert_rank").alias("worst_payment_type"),
        F.max("pct_below_national_avg").alias("highest_pct_below"),
    )
    ranked = rank_rows(totals, "state_rank", [F.desc("total_leakage_score"), F.asc("state")])
    rounded = ["total_leakage_score", "total_revenue_at_risk", "highest_pct_below"]
    return ranked.withColumns({c: half_even(c, 2) for c in rounded})


def leakage_critical(alerts: DataFrame) -> DataFrame:
    """Alerts on payment types that should not occur at all."""
    return alerts.where(F.col("payment_type").isin(*CRITICAL_PAYMENT_TYPES)).select(
        "state", "payment_type", "order_count", "avg_value", "remediation"
    )


def national_avg_check(detail: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Configured national mean next to the one in the data."""
    return detail.agg(exact_mean("total_payment_value").alias("live_avg")).select(
        F.lit(float(cfg.national_avg_order_value)).alias("configured_avg"),
        "live_avg",
        (F.col("live_avg") - F.lit(float(cfg.national_avg_order_value))).alias("difference"),
    )
