"""Points, triggers, audiences and timing on hand-made marts."""

import pytest
from pyspark.sql import functions as F

from martloom.config import TRIGGER_ACTIONS, Config
from martloom.plans.insights import channels, kpis, marketing, points, timing

PROFILE = """customer_unique_id string, customer_state string, customer_city string, total_orders bigint, total_spend double,
    avg_order_value double, is_high_value int, preferred_payment_type string, max_installments_used int,
    uses_installments int, avg_review_score double, installment_bucket string"""
REPEAT = "customer_unique_id string, is_repeat_customer int, days_active int"


@pytest.fixture(scope="module")
def shop(spark):
    profile = spark.createDataFrame(
        [
            ("a", "SP", "x", 2, 3000.0, 1500.0, 1, "credit_card", 13, 1, 4.0, "12+"),
            ("b", "BA", "x", 1, 400.0, 400.0, 1, "boleto", 1, 0, 0.0, "1"),
            ("c", "RJ", "x", 1, 100.0, 100.0, 0, "voucher", 3, 1, 5.0, "2-6"),
            ("d", "BA", "x", 3, 90.0, 30.0, 0, "credit_card", 1, 0, 1.0, "1"),
            ("e", "BA", "x", 1, 0.0, None, 0, "unknown", 0, 0, 0.0, "1"),
        ],
        PROFILE,
    )
    repeat = spark.createDataFrame([("a", 1, 40), ("b", 0, 0), ("c", 0, 0), ("d", 1, 9)], REPEAT)
    hv = spark.createDataFrame(
        [("a", "toys", 1, 900.0), ("a", "health_beauty", 1, 900.0), ("a", "books", 4, 100.0), ("b", "toys", 1, 1.0)],
        "customer_unique_id string, product_category_en string, order_count bigint, total_spend double",
    )
    return profile, repeat, hv


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_customer_points(shop):
    p = by(points.customer_points(shop[0], shop[2], shop[1]), "customer_unique_id")
    # 3000 x 2.0 x 1.5 x 1.2 + 50
    assert (p["a"].total_points, p["a"].tier, p["a"].next_tier, p["a"].points_to_next) == (10850.0, "Platinum", "Platinum", 0.0)
    assert (p["b"].category_mult, p["b"].review_bonus, p["b"].total_points) == (1.0, 0, 400.0)
    # the distance is measured to the end of the next tier, not to its start
    assert (p["b"].tier, p["b"].next_tier, p["b"].points_to_next) == ("Bronze", "Silver", 1600.0)
    assert p["c"].total_points == 170.0  # 100 x 1.2 + 50
    assert {k: r.marketing_audience for k, r in p.items()} == {
        "a": "HVC Loyal", "b": "HVC One-Time", "c": "RC Upgrade Path", "d": "RC Single-Pay", "e": "RC Single-Pay",
    }


def test_seller_points_and_tier_summary(spark, shop):
    sellers = spark.createDataFrame(
        [("s1", 100, 5000.0, 200.0, 4.5), ("s2", 10, 848.0, 180.52, 3.0), ("s3", 10, 3520.0, 100.0, 4.0)],
        "seller_id string, total_orders bigint, total_revenue double, avg_order_value double, avg_review_score double",
    )
    s = by(points.seller_points(sellers), "seller_id")
    assert (s["s1"].base_points, s["s1"].category_bonus, s["s1"].total_points, s["s1"].tier) == (45000.0, 1.3, 58500.0, "Platinum")
    assert (s["s1"].ad_credit_value, s["s1"].revenue_tier) == (5850.0, "Premium")
    assert (s["s2"].category_bonus, s["s2"].revenue_tier, s["s2"].points_to_next) == (1.0, "Starter", 17000.0)
    assert s["s3"].revenue_tier == "Growth"
    customers = points.customer_points(shop[0], shop[2], shop[1])
    rows = by(points.tier_summary(customers, points.seller_points(sellers)), "tier")
    assert list(rows) and set(rows) == {"Platinum", "Gold", "Silver", "Bronze"}
    assert (rows["Gold"].customer_count, rows["Gold"].avg_customer_points, rows["Gold"].seller_pct) == (0, 0.0, 0.0)
    assert (rows["Bronze"].customer_count, rows["Bronze"].customer_pct, rows["Bronze"].seller_count) == (4, 80.0, 2)
    assert (rows["Platinum"].hvc_in_tier_pct, rows["Platinum"].avg_seller_ad_credit) == (100.0, 5850.0)
    impact = by(points.installment_impact(customers), "installment_bucket")
    assert (impact["1"].customers, impact["1"].avg_base_points) == (3, 163.3)


def test_triggers(shop):
    t = by(marketing.trigger_segments(shop[0], shop[1]), "customer_unique_id")
    flags = {k: tuple(r[c] for c in r.__fields__ if c.startswith("T")) for k, r in t.items()}
    # the median order value is (100 + 400) / 2; a missing value or repeat row never fires
    assert flags == {
        "a": (1, 0, 0, 0, 0),
        "b": (1, 1, 0, 1, 1),
        "c": (1, 0, 0, 1, 0),
        "d": (1, 0, 0, 0, 0),
        "e": (1, 0, 0, 0, 0),
    }
    assert (t["b"].active_triggers, t["b"].primary_trigger) == (4, "T1_post_purchase_review")
    assert t["b"].trigger_action == TRIGGER_ACTIONS["post_purchase_review"]
    idle = shop[0].where("customer_unique_id = 'e'").withColumn("total_orders", F.lit(0).cast("bigint"))
    none = marketing.trigger_segments(idle, shop[1]).first()
    assert (none.primary_trigger, none.trigger_action) == ("none", "No action")
    summary = by(marketing.trigger_summary(marketing.trigger_segments(shop[0], shop[1])), "trigger")
    assert (summary["T4_re_engagement"].customer_count, summary["T4_re_engagement"].pct) == (2, 40.0)
    assert (summary["at_least_one"].customer_count, summary["at_least_two"].customer_count) == (5, 2)


def test_audiences(shop):
    a = by(marketing.audience_segments(shop[0], shop[1], shop[2]), "customer_unique_id")
    assert {k: r.audience_segment for k, r in a.items()} == {
        "a": "hvc_loyal", "b": "hvc_one_time", "c": "rc_single_pay", "d": "rc_upgrade_path", "e": "rc_single_pay",
    }
    # equal spend: the first category by name
    assert (a["a"].top_category, a["a"].is_hvc_category) == ("health_beauty", 1)
    assert (a["c"].top_category, a["c"].is_hvc_category) == ("unknown", 0)
    frame = marketing.audience_segments(shop[0], shop[1], shop[2])
    s = by(marketing.segment_summary(frame), "audience_segment")
    assert (s["rc_single_pay"].customer_count, s["rc_single_pay"].avg_spend, s["rc_single_pay"].avg_order_value) == (2, 50.0, 100.0)
    assert s["hvc_loyal"].strategy.startswith("Exclusive early access")
    assert [tuple(r) for r in marketing.hvc_loyal_top_categories(frame).collect()] == [("health_beauty", 1)]


def test_category_timing(spark):
    rows = [("toys", f"2017-{m:02d}", float(100 + m)) for m in range(1, 13)]
    rows += [("watches_gifts", "2017-05", 10.0), ("watches_gifts", "2018-05", 5.5), ("watches_gifts", "2017-03", 12.0),
             ("watches_gifts", "2017-01", 12.0), ("watches_gifts", "2017-12", 1.0)]
    df = spark.createDataFrame(rows, "product_category_en string, year_month string, total_revenue double")
    got = timing.category_timing(df).collect()
    assert [tuple(r)[:5] for r in got] == [("watches_gifts", "May, January, March", [5, 1, 3], 16.0, "May")]


def test_profiles_and_segments_leave_out_blanks(spark):
    rows = [("cat", "pet", "reseller", 10), ("cat", "pet", "reseller", 21), ("eagle", "toys", "manufacturer", 44),
            ("odd", "unknown", "reseller", 200), ("unknown", "pet", "reseller", 1)]
    df = spark.createDataFrame(
        [(str(i), *r) for i, r in enumerate(rows)],
        "seller_id string, lead_behaviour_profile string, business_segment string, business_type string, days_to_close int",
    )
    close = by(channels.profile_close_time(df), "lead_behaviour_profile")
    assert set(close) == {"cat", "eagle", "odd"}
    assert (close["cat"].avg_days_to_close, close["cat"].median_days_to_close) == (15.5, 15.5)
    assert (close["eagle"].onboarding_package, close["odd"].onboarding_package) == ("Fast-Track (<45 days)", "High-Touch Support (>90 days)")
    share = by(channels.segment_distribution(df), "business_segment")
    assert (share["pet"].converted_count, share["pet"].pct_resellers, share["pet"].platform_share_pct) == (3, 100.0, 75.0)
    package = by(channels.profile_onboarding_packages(df), "lead_behaviour_profile")
    assert package["odd"].onboarding_package == "Standard Nurture - default 60-day sequence"


def test_executive_kpis(shop):
    profile, repeat, _ = shop
    flagged = repeat.join(profile.select("customer_unique_id", "is_high_value"), "customer_unique_id")
    got = {(r.kpi, r.segment): r.value for r in kpis.executive_kpis(profile, flagged, Config()).collect()}
    assert got["hvc_spend_threshold", "all"] == 400.0
    assert got["hvc_revenue_share", "all"] == pytest.approx(3400 / 3590)
    assert (got["repeat_customer_rate", "high_value"], got["repeat_customer_rate", "regular"]) == (0.5, 0.5)
    assert got["spend_per_order", "12+"] == 1500.0
