"""Published results: inputs and outputs as numbers."""

from pyspark.sql import functions as F

from martloom.config import SEASONAL_EVENTS
from martloom.plans.insights import channels, leakage, timing

# Published monthly totals (month, revenue, orders) and the calendar built from them.
MONTHLY = [
    ("2016-09", 136.23, 2), ("2016-10", 47813.46, 273), ("2016-12", 19.62, 1), ("2017-01", 130510.12, 766),
    ("2017-02", 275623.74, 1675), ("2017-03", 418978.27, 2591), ("2017-04", 397598.56, 2353), ("2017-05", 576106.42, 3601),
    ("2017-06", 496068.51, 3182), ("2017-07", 575042.0, 3928), ("2017-08", 652419.31, 4234), ("2017-09", 708621.4, 4188),
    ("2017-10", 757563.7, 4511), ("2017-11", 1162150.28, 7361), ("2017-12", 850702.03, 5570), ("2018-01", 1090459.92, 7143),
    ("2018-02", 978178.51, 6612), ("2018-03", 1141298.65, 7136), ("2018-04", 1152799.62, 6897), ("2018-05", 1137672.32, 6803),
    ("2018-06", 1020067.53, 6142), ("2018-07", 1036087.25, 6219), ("2018-08", 993832.9, 6398), ("2018-09", 166.46, 1),
]
CALENDAR = [
    (1, "January", 5.7, "MEDIUM", 14, False, 610485.0, 3954.0, 8.0, 2),
    (2, "February", 5.1, "MEDIUM", 14, False, 626901.0, 4144.0, 7.1, 2),
    (3, "March", 6.6, "MEDIUM", 14, False, 780138.0, 4864.0, 9.2, 2),
    (4, "April", 6.6, "MEDIUM", 14, False, 775199.0, 4625.0, 9.2, 2),
    (5, "May", 7.0, "MEDIUM", 14, True, 856889.0, 5202.0, 9.8, 2),
    (6, "June", 6.1, "MEDIUM", 14, False, 758068.0, 4662.0, 8.5, 2),
    (7, "July", 6.4, "MEDIUM", 14, False, 805565.0, 5074.0, 8.9, 2),
    (8, "August", 6.4, "MEDIUM", 14, False, 823126.0, 5316.0, 8.9, 2),
    (9, "September", 3.3, "LOW", 7, False, 236308.0, 1397.0, 4.6, 3),
    (10, "October", 4.4, "LOW", 7, False, 402689.0, 2392.0, 6.1, 2),
    (11, "November", 10.0, "HIGH", 21, True, 1162150.0, 7361.0, 14.0, 1),
    (12, "December", 4.0, "LOW", 7, False, 425361.0, 2786.0, 5.6, 2),
]
# state, type, orders, mean value, score, % below, severity, flag, money at risk, action
ALERTS = [
    ("SP", "credit_card", 31912, 148.1182254324392, 2551.241484851714, 8.0, "CRITICAL", True, 410764.07,
     "Push 12-installment plan for SP credit card orders above R$ 180.52. 8.0% below national avg across 31,912 transactions."),
    ("SP", "boleto", 8205, 132.18823156611822, 1467.8514170403655, 17.89, "HIGH", True, 236318.51,
     "Offer SP boleto customers credit-card-with-installment upgrade at checkout. 17.9% below national avg."),
    ("SP", "voucher", 866, 113.41247113163972, 255.9246848877946, 29.55, "LOW", True, 41202.14,
     "SP voucher: 29.6% below national avg. Investigate checkout flow for friction points."),
    ("MG", "boleto", 2304, 147.79457465277778, 188.827875887861, 8.2, "LOW", True, 30402.26,
     "MG boleto: 8.2% below national avg. Monitor weekly."),
    ("BA", "boleto", 614, 154.75521172638437, 23.773910562038985, 3.87, "LOW", False, 3828.16,
     "BA boleto: 3.9% below national avg. Monitor weekly."),
    ("MS", "boleto", 175, 157.69594285714285, 3.5792794258387803, 2.05, "LOW", False, 576.46,
     "MS boleto: 2.0% below national avg. Monitor weekly."),
    ("SP", "not_defined", 3, 0.0, 3.0, 0.0, "LOW", False, 482.97,
     "CRITICAL ROUTING ERROR - not_defined linked to review scores 1.0-1.67. Escalate to payment ops. Manual review within 24h SLA."),
    ("SP", "unknown", 1, 0.0, 1.0, 0.0, "LOW", False, 160.99,
     "CRITICAL ROUTING ERROR - unknown linked to review scores 1.0-1.67. Escalate to payment ops. Manual review within 24h SLA."),
    ("PB", "voucher", 13, 160.59538461538463, 0.0317564045854829, 0.25, "LOW", False, 5.13,
     "PB voucher: 0.2% below national avg. Monitor weekly."),
    ("ES", "credit_card", 1564, 160.98649616368286, 0.0209025094018246, 0.0, "LOW", False, 5.48,
     "ES credit_card: 0.0% below national avg. Monitor weekly."),
]
# End of the fixed values.
# origin, leads, converted, rate, log volume, efficiency, rank, budget %
CHANNELS = [
    ("unknown", 1159, 193, 16.65, 7.0562, 1.175019, 1, 22.0),
    ("organic_search", 2296, 271, 11.8, 7.7394, 0.913492, 2, 17.1),
    ("paid_search", 1586, 195, 12.3, 7.3696, 0.906098, 3, 17.0),
    ("direct_traffic", 499, 56, 11.22, 6.2146, 0.69743, 4, 13.1),
    ("referral", 284, 24, 8.45, 5.6525, 0.477676, 5, 9.0),
    ("social", 1350, 75, 5.56, 7.2086, 0.400478, 6, 7.5),
    ("display", 118, 6, 5.08, 4.7791, 0.243005, 7, 4.6),
    ("other_publicities", 65, 3, 4.62, 4.1897, 0.193371, 8, 3.6),
    ("email", 493, 15, 3.04, 6.2025, 0.188717, 9, 3.5),
    ("other", 150, 4, 2.67, 5.0173, 0.133795, 10, 2.5),
]


def calendar(spark):
    monthly = spark.createDataFrame(MONTHLY, "year_month string, total_revenue double, order_count bigint")
    return timing.campaign_calendar(monthly)


def test_campaign_calendar(spark):
    got = calendar(spark).orderBy("calendar_month").collect()
    columns = (
        "calendar_month month_name intensity_score intensity_band pre_launch_days flash_sale_flag avg_revenue avg_orders "
        "campaign_budget_weight data_points"
    ).split()
    assert [tuple(r[c] for c in columns) for r in got] == CALENDAR
    assert [r.seasonal_event for r in got] == list(SEASONAL_EVENTS.values())


def test_flash_windows_and_band_budget(spark):
    flash = timing.flash_sale_windows(calendar(spark)).orderBy("calendar_month").collect()
    assert [(r.calendar_month, r.flash_sale_type, r.recommended_window, r.channel_priority, r.campaign_budget_weight) for r in flash] == [
        (5, "Standard Flash Sale (24h)", "Week 3 of the month", "Email + Display", 9.8),
        (11, "Major Flash Event (48-72h)", "Week 2 and Week 4 of the month", "Push + Email + Display + Retargeting", 14.0),
    ]
    bands = {r.intensity_band: (r.month_count, r.budget_pct, r.months) for r in timing.campaign_band_budget(calendar(spark)).collect()}
    assert bands["HIGH"] == (1, 14.0, "November")
    assert bands["LOW"] == (3, 16.3, "September, October, December")
    assert bands["MEDIUM"][0] == 8


def alerts(spark):
    rows = [("2026-05-28", a[0], a[1], a[2], a[3], a[4]) for a in ALERTS] + [("2026-05-28", "AC", "boleto", 16, 244.27875, 0.0)]
    marts = spark.createDataFrame(
        rows, "analysis_date string, state string, payment_type string, order_count bigint, avg_value double, leakage_score double"
    )
    return leakage.leakage_alerts(marts)


def test_leakage_alerts(spark):
    got = alerts(spark).orderBy("alert_rank").collect()
    columns = "state payment_type order_count avg_value leakage_score pct_below_national_avg severity alert_flag revenue_at_risk remediation".split()
    by_score = sorted(ALERTS, key=lambda a: -a[4])
    assert [tuple(r[c] for c in columns) for r in got] == by_score
    assert [r.alert_rank for r in got] == list(range(1, 11))


def test_state_summary_and_routing_failures(spark):
    got = {r.state: r for r in leakage.leakage_state_summary(alerts(spark)).collect()}
    sp = got["SP"]
    assert (sp.state_rank, sp.num_payment_types, sp.worst_payment_type, sp.highest_pct_below) == (1, 5, "credit_card", 29.55)
    assert sp.total_leakage_score == 4279.02 and sp.total_orders_affected == 40987
    assert (got["MG"].state_rank, got["MG"].total_revenue_at_risk) == (2, 30402.26)
    assert sorted(r.payment_type for r in leakage.leakage_critical(alerts(spark)).collect()) == ["not_defined", "unknown"]


def test_channel_report(spark):
    leads = spark.createDataFrame([(o, n, c) for o, n, c, *_ in CHANNELS], "origin string, n int, c int").select(
        F.when(F.col("origin") == "unknown", "").otherwise(F.col("origin")).alias("origin"),
        "c",
        F.posexplode(F.sequence(F.lit(1), F.col("n"))).alias("i", "_"),
    ).withColumn("mql_id", F.concat_ws("-", "origin", "i"))
    got = channels.channel_efficiency(leads, leads.where("i < c")).orderBy("rank").collect()
    columns = "origin total_leads converted_leads conversion_rate_pct log_volume efficiency_score rank budget_allocation_pct".split()
    assert [tuple(r[c] for c in columns) for r in got] == CHANNELS
    assert [r.action_priority[:2] for r in got] == ["P0", "P1", "P2", "P2"] + ["P3"] * 6
    assert got[1].recommendation == "INCREASE - Rank 2 by efficiency. Scale budget 20-30%."
