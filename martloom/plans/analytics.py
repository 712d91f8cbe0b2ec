"""Analytics outputs by name, each from the marts it reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.plans.insights import channels, kpis, leakage, marketing, points, timing
from martloom.plans.pipeline import ACQUISITION, DETAIL, PROFILE, Marts
from martloom.sources.marts import write_csv

REPEAT = "mart_repeat_customer"
HV_CATEGORY = "mart_hv_category_preference"
SELLERS = "mart_seller_performance"


def _alerts(m: Marts) -> DataFrame:
    return leakage.leakage_alerts(m.mart("mart_payment_leakage"), m.cfg)


def _calendar(m: Marts) -> DataFrame:
    return timing.campaign_calendar(m.mart("mart_monthly_revenue"))


def _customer_points(m: Marts) -> DataFrame:
    m.detail_and_profile()
    return points.customer_points(m.mart(PROFILE), m.mart(HV_CATEGORY), m.mart(REPEAT), m.cfg)


def _seller_points(m: Marts) -> DataFrame:
    return points.seller_points(m.mart(SELLERS), m.cfg)


def _triggers(m: Marts) -> DataFrame:
    return marketing.trigger_segments(m.mart(PROFILE), m.mart(REPEAT), m.cfg, m.part("customer_quantiles"))


def _audiences(m: Marts) -> DataFrame:
    m.detail_and_profile()
    return marketing.audience_segments(m.mart(PROFILE), m.mart(REPEAT), m.mart(HV_CATEGORY), m.cfg)


ANALYTICS: dict[str, Callable[[Marts], DataFrame]] = {
    "channel_efficiency": lambda m: channels.channel_efficiency(m.raw["mql"], m.mart(ACQUISITION)),
    "profile_close_time": lambda m: channels.profile_close_time(m.mart(ACQUISITION)),
    "segment_distribution": lambda m: channels.segment_distribution(m.mart(ACQUISITION)),
    "profile_onboarding_packages": lambda m: channels.profile_onboarding_packages(m.mart(ACQUISITION)),
    "customer_points": _customer_points,
    "seller_points": _seller_points,
    "tier_summary": lambda m: points.tier_summary(_customer_points(m), _seller_points(m), m.cfg),
    "installment_impact": lambda m: points.installment_impact(_customer_points(m)),
    "audience_distribution": lambda m: points.audience_distribution(_customer_points(m)),
    "leakage_alerts": _alerts,
    "leakage_state_summary": lambda m: leakage.leakage_state_summary(_alerts(m)),
    "leakage_critical": lambda m: leakage.leakage_critical(_alerts(m)),
    "national_avg_check": lambda m: leakage.national_avg_check(m.mart(DETAIL), m.cfg),
    "campaign_calendar": _calendar,
    "category_timing": lambda m: timing.category_timing(m.mart("mart_product_price_range"), m.cfg),
    "flash_sale_windows": lambda m: timing.flash_sale_windows(_calendar(m)),
    "campaign_band_budget": lambda m: timing.campaign_band_budget(_calendar(m)),
    "trigger_segments": _triggers,
    "trigger_summary": lambda m: marketing.trigger_summary(_triggers(m)),
    "audience_segments": _audiences,
    "segment_summary": lambda m: marketing.segment_summary(_audiences(m)),
    "hvc_loyal_top_categories": lambda m: marketing.hvc_loyal_top_categories(_audiences(m)),
    "executive_kpis": lambda m: kpis.executive_kpis(
        m.mart(PROFILE), m.mart(REPEAT), m.cfg, m.part("customer_quantiles")
    ),
}

# report -> sort columns, a leading minus for descending
REPORTS = {
    "channel_efficiency": ["rank"],
    "profile_close_time": ["avg_days_to_close"],
    "segment_distribution": ["-converted_count"],
    "profile_onboarding_packages": ["avg_days"],
    "customer_points": ["-total_points"],
    "seller_points": ["-total_points"],
    "tier_summary": ["-avg_customer_points"],
    "leakage_alerts": ["alert_rank"],
    "leakage_state_summary": ["state_rank"],
    "campaign_calendar": ["calendar_month"],
    "category_timing": ["category"],
    "flash_sale_windows": ["calendar_month"],
    "trigger_segments": ["customer_unique_id"],
    "audience_segments": ["customer_unique_id"],
    "segment_summary": ["-customer_count"],
}


def in_order(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.orderBy(*[F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in columns])


def write_reports(marts: Marts, folder: str, names=tuple(REPORTS)) -> list[str]:
    """Write reports as CSV folders, each sorted across its files."""
    for name in names:
        write_csv(in_order(ANALYTICS[name](marts), REPORTS[name]), f"{folder.rstrip('/')}/{name}")
    return list(names)
