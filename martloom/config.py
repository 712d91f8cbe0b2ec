"""Every threshold, category list and text the jobs use, in one overridable place."""

from __future__ import annotations

from dataclasses import dataclass

# Constants, bands and texts that results must carry unchanged.

COMPLETED_STATUSES = ("delivered", "shipped", "approved")
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")
CRITICAL_PAYMENT_TYPES = ("not_defined", "unknown")
TOP_CATEGORIES = ("watches_gifts", "health_beauty", "computers_accessories", "sports_leisure", "bed_bath_table")
FRONTIER_STATES = ("SP", "MG", "RS", "PR", "RJ")

# (upper edge, label); a value belongs to the first band whose edge is not below it
INSTALLMENT_BANDS = ((1, "1"), (6, "2-6"), (12, "7-12"), (None, "12+"))
PRICE_BANDS = ((50, "A. 0-50"), (150, "B. 50-150"), (500, "C. 150-500"), (None, "D. 500+"))
SELLER_REVENUE_BANDS = ((848, "Starter"), (3520, "Growth"), (None, "Premium"))
PRIORITY_BANDS = ((0.4, "LOW"), (0.7, "MEDIUM"), (None, "HIGH"))
LEAD_PACKAGE_BANDS = (
    (45, "Fast-Track (<=45 days)"),
    (90, "Standard Nurture (<=90 days)"),
    (None, "High-Touch Support (>90 days)"),
)

# (lower edge, label); a value belongs to the first tier whose edge it reaches
CUSTOMER_TIERS = ((5000, "Platinum"), (2000, "Gold"), (500, "Silver"), (0, "Bronze"))
SELLER_TIERS = ((50000, "Platinum"), (20000, "Gold"), (5000, "Silver"), (0, "Bronze"))
SEVERITY_TIERS = ((2000, "CRITICAL"), (1000, "HIGH"), (500, "MEDIUM"), (0, "LOW"))
INTENSITY_TIERS = ((8, "HIGH"), (5, "MEDIUM"), (0, "LOW"))
CONFIDENCE_TIERS = ((0.80, "12+"), (0.65, "7-12"), (0.50, "2-6"), (0.00, "1"))

CONFIDENCE_REASONS = {
    "12+": "High confidence: proactively surface 12-installment option",
    "7-12": "Medium confidence: show 7-12 installment option",
    "2-6": "Low confidence: show basic 2-6 installment option",
    "1": "Unlikely to use installments: do not surface installment prompt",
}
OVERRIDE_REASON_BATCH = "LEAKAGE OVERRIDE: leakage state + credit card + order > HVC threshold"

INSTALLMENT_MULTIPLIERS = {"1": 1.0, "2-6": 1.0, "7-12": 1.0, "12+": 2.0}
CATEGORY_MULTIPLIER = 1.5
FRONTIER_MULTIPLIER = 1.2
REVIEW_BONUS = 50
SELLER_VALUE_MULTIPLIER = 1.3
AD_CREDIT_SHARE = 0.10

SELLER_AD_PACKAGES = {
    "Starter": "Basic listing + onboarding analytics + category page placement",
    "Growth": "Featured product slots + keyword-targeted display + enhanced analytics",
    "Premium": "Banner ads + HVC segment targeting + cross-sell placements + account manager",
}
CLUSTER_AD_PACKAGES = {
    "Starter": "Basic product listing | Onboarding analytics dashboard | Category page placement",
    "Growth": "Featured product slots | Keyword-targeted display ads | Enhanced analytics | Category targeting",
    "Premium": "Banner ads | HVC segment targeting | Cross-sell placements | Dedicated account manager | "
    "Priority in watches/health_beauty/computers",
}
ONBOARDING_PACKAGES = {
    "eagle": "Fast-Track - dedicated SDR, 7-day onboarding, priority listing",
    "cat": "Fast-Track - structured 2-week onboarding, category advisor",
    "wolf": "Standard Nurture - 90-day drip sequence, bi-weekly check-in",
    "shark": "High-Touch Support - 60-day intensive, legal/compliance review",
    "cat, wolf": "Extended Nurture - 120-day sequence, category + ops support",
    "eagle, wolf": "Extended Nurture - 120-day sequence, revenue-focused advisor",
    "eagle, cat": "Fast-Track Plus - 3-week onboarding, early ad credit",
    "shark, cat": "High-Touch Support - compliance-first, 45-day structured path",
    "shark, wolf": "High-Touch Support - longest cycle expected, executive sponsor",
}
DEFAULT_ONBOARDING = "Standard Nurture - default 60-day sequence"

CHANNEL_FIX_TRACKING = (
    "FIX UTM FIRST - 16.7% conversion but 0% attribution. "
    "Enforce UTM params on all landing pages before any spend increase."
)
CHANNEL_PAUSE = "PAUSE - Zero efficiency. Investigate before any new spend."
CHANNEL_INCREASE = "INCREASE - Rank %d by efficiency. Scale budget 20-30%%."
CHANNEL_MAINTAIN = "MAINTAIN - Solid efficiency. Review quarterly."
CHANNEL_REDUCE = (
    "REDUCE - Below-median efficiency. Reallocate to Rank 1-2 channels. A/B test creative before cutting."
)
CHANNEL_PRIORITIES = (
    "P0 - Fix UTM tracking (Week 1)",
    "P1 - Scale now",
    "P2 - Maintain and monitor",
    "P3 - Reduce and reallocate",
)
CLOSE_TIME_PACKAGES = (
    "Fast-Track (<45 days)",
    "Standard Nurture (45-90 days)",
    "High-Touch Support (>90 days)",
)

SEASONAL_EVENTS = {
    1: "Liquidação de Janeiro / Summer clearance",
    2: "Carnaval season - electronics + fashion pre-event",
    3: "Back-to-school close / Easter prep",
    4: "Páscoa (Easter) - chocolate, home, gifts",
    5: "Dia das Mães (2nd Sunday) - biggest gifting event after BF",
    6: "Dia dos Namorados (June 12) - beauty, jewelry, electronics",
    7: "Férias de julho - travel, toys, leisure",
    8: "Dia dos Pais (2nd Sunday) - electronics, tools, sports",
    9: "Volta às aulas / Spring promo",
    10: "Dia das Crianças (Oct 12) - toys, games, apparel",
    11: "Black Friday - highest sales event of the year",
    12: "Natal / Christmas + end-of-year clearance",
}
LAUNCH_DAYS = {"HIGH": 21, "MEDIUM": 14, "LOW": 7}
FLASH_SCORE = 7
MAJOR_FLASH_SCORE = 9
FLASH_TYPES = ("Major Flash Event (48-72h)", "Standard Flash Sale (24h)")
FLASH_WINDOWS = {"HIGH": "Week 2 and Week 4 of the month", "MEDIUM": "Week 3 of the month"}
FLASH_CHANNELS = ("Push + Email + Display + Retargeting", "Email + Display")

AUDIENCE_STRATEGIES = {
    "hvc_loyal": "Exclusive early access to Black Friday + Dia das Mães campaigns. "
    "12-installment option pre-surfaced. Dedicated retention email cadence (bi-weekly).",
    "hvc_one_time": "Win-back campaign at 30d post-purchase. "
    "Personalized category recommendation based on first-order category. "
    "Incentivize second order with 10% category voucher.",
    "rc_upgrade_path": "Upgrade to installment plan at next checkout. "
    "Show HVC threshold progress ('R$X away from HVC status'). "
    "Target with mid-tier category upsell (C. 150-500 bucket).",
    "rc_single_pay": "Credit card + installment education email. "
    "Low-value promotional entry offer to encourage repeat. "
    "Re-engagement trigger at 90 days inactivity.",
}
TRIGGERS = (
    "T1_post_purchase_review",
    "T2_installment_upgrade",
    "T3_payment_anomaly",
    "T4_re_engagement",
    "T5_hvc_upsell",
)
TRIGGER_ACTIONS = {
    "post_purchase_review": "Send review request email 5 days after estimated delivery. "
    "If review score >= 4, surface upsell recommendation.",
    "installment_upgrade": "At next checkout: display credit card + 6-installment option side-by-side with boleto. "
    "Show monthly installment value prominently.",
    "payment_anomaly": "Flag to customer ops within 24h. "
    "Send payment method clarification email. "
    "Offer credit card as preferred fallback.",
    "re_engagement": "Day 90: re-engagement email with top category deals. "
    "Day 105: SMS/push with discount code. "
    "Day 120: final win-back offer before suppression.",
    "hvc_upsell": "Surface 12-installment plan at checkout. "
    "Add loyalty point multiplier badge to product page. "
    "Invite to HVC early-access sale event.",
}

# thresholds and model parameters as published
PUBLISHED = {
    "hvc_quantile": 0.75,
    "hvc_spend_threshold": 180.52,
    "installments_above": 1.0,
    "national_avg_order_value": 160.99,
    "leakage_alert_pct": 5.0,
    "push_plan_score": 1000.0,
    "offer_upgrade_score": 500.0,
    "friction_pct": 10.0,
    "default_state": "SP",
    "folds": 5,
    "seed": 42,
    "encoding_smoothing": 10.0,
    "boosting_rounds": 400,
    "boosting_depth": 4,
    "boosting_rate": 0.05,
    "boosting_row_share": 0.8,
    "boosting_feature_share": 0.8,
    "boosting_min_rows": 3,
    "boosting_l1": 0.1,
    "boosting_l2": 1.0,
    "seller_clusters": 3,
    "cluster_range": (2, 3, 4, 5, 6),
    "cluster_range_starts": 10,
    "cluster_starts": 20,
}

# what to do about an alert; names in braces are filled in
ALERT_TEXTS = {
    "routing": "CRITICAL ROUTING ERROR - {kind} linked to review scores 1.0-1.67. Escalate to payment ops. Manual review within 24h SLA.",
    "plan": "Push 12-installment plan for {state} credit card orders above R$ {threshold}. "
    "{gap}% below national avg across {orders} transactions.",
    "upgrade": "Offer {state} boleto customers credit-card-with-installment upgrade at checkout. {gap}% below national avg.",
    "friction": "{state} {kind}: {gap}% below national avg. Investigate checkout flow for friction points.",
    "watch": "{state} {kind}: {gap}% below national avg. Monitor weekly.",
}
OVERRIDE_REASON_CHECKOUT = (
    "LEAKAGE OVERRIDE: {state} credit card order > R${threshold}. Always surface 12-installment per Module 5 rule layer."
)

# End of the fixed values.


@dataclass(frozen=True)
class Config:
    """Values a deployment may need to move; the defaults are the published ones."""

    hvc_quantile: float = PUBLISHED["hvc_quantile"]
    hvc_spend_threshold: float = PUBLISHED["hvc_spend_threshold"]
    installments_above: float = PUBLISHED["installments_above"]
    national_avg_order_value: float = PUBLISHED["national_avg_order_value"]
    leakage_alert_pct: float = PUBLISHED["leakage_alert_pct"]
    push_plan_score: float = PUBLISHED["push_plan_score"]
    offer_upgrade_score: float = PUBLISHED["offer_upgrade_score"]
    friction_pct: float = PUBLISHED["friction_pct"]
    top_categories: tuple = TOP_CATEGORIES
    frontier_states: tuple = FRONTIER_STATES
    default_state: str = PUBLISHED["default_state"]
    customer_tiers: tuple = CUSTOMER_TIERS
    seller_tiers: tuple = SELLER_TIERS
    seller_revenue_bands: tuple = SELLER_REVENUE_BANDS
    severity_tiers: tuple = SEVERITY_TIERS
    folds: int = PUBLISHED["folds"]
    seed: int = PUBLISHED["seed"]
    encoding_smoothing: float = PUBLISHED["encoding_smoothing"]
    boosting_rounds: int = PUBLISHED["boosting_rounds"]
    boosting_depth: int = PUBLISHED["boosting_depth"]
    boosting_rate: float = PUBLISHED["boosting_rate"]
    boosting_row_share: float = PUBLISHED["boosting_row_share"]
    boosting_feature_share: float = PUBLISHED["boosting_feature_share"]
    boosting_min_rows: int = PUBLISHED["boosting_min_rows"]
    boosting_l1: float = PUBLISHED["boosting_l1"]
    boosting_l2: float = PUBLISHED["boosting_l2"]
    # sizes of sketches that replace exact quantiles and distinct counts, where those cost too much
    quantile_sketch: int | None = None
    distinct_sketch: int | None = None
    seller_clusters: int = PUBLISHED["seller_clusters"]
    cluster_range: tuple = PUBLISHED["cluster_range"]
    cluster_range_starts: int = PUBLISHED["cluster_range_starts"]
    cluster_starts: int = PUBLISHED["cluster_starts"]
