"""From raw CSV files to all marts, with values worked out by hand."""

import datetime as dt
from pathlib import Path

import pytest
import raw_fixture
from pyspark.sql import functions as F

from martloom.config import Config
from martloom.plans.pipeline import STEPS, Marts, bucketed_store, folder_store, run_all, run_daily
from martloom.schemas import MART_DDL, mart_schema
from martloom.session import cut
from martloom.sources import marts as M
from martloom.sources.quality import Rule, default_rules, dq_report, not_negative, not_null, validate
from martloom.sources.raw import read_all_raw, read_all_typed, read_csv, read_raw, require_inputs


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    return raw_fixture.write(tmp_path_factory.mktemp("raw"))


@pytest.fixture(scope="module")
def built(spark, shop, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("marts"))
    marts = Marts(read_all_raw(spark, shop), folder_store(folder), Config(), F.lit("2018-05-01").cast("date"), cut)
    return run_all(marts), folder


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_every_mart_has_its_declared_columns(built):
    marts, _ = built
    assert set(marts) == set(MART_DDL) == {n for s in STEPS for n in s}
    for name, df in marts.items():
        got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
        assert got == [(f.name, f.dataType.simpleString()) for f in mart_schema(name).fields], name


def test_load_repairs(spark, shop):
    customers = by(read_raw(spark, shop, "customers"), "customer_id")
    assert customers["c1"].customer_zip_code_prefix == "01310"
    assert "product_name_length" in read_raw(spark, shop, "products").columns
    reviews = by(read_raw(spark, shop, "order_reviews"), "review_id")
    assert len(reviews) == 4 and reviews["r1"].review_comment_message == 'good,\ntwo "lines"'
    assert reviews["r2"].review_comment_title == ""
    deals = by(read_raw(spark, shop, "closed_deals"), "mql_id")
    assert (deals["m1"].has_company, deals["m1"].has_gtin, deals["m3"].has_gtin) == ("True", "", "False")
    assert by(read_raw(spark, shop, "orders"), "order_id")["o3"].order_delivered_customer_date is None


def test_missing_inputs_are_all_named(spark, tmp_path):
    raw_fixture.write(tmp_path)
    (tmp_path / "mql.csv").unlink()
    (tmp_path / "sellers.csv").unlink()
    with pytest.raises(FileNotFoundError, match=r"sellers\.csv.*mql\.csv"):
        require_inputs(spark, str(tmp_path))


def test_customer_profile(built):
    p = by(built[0]["mart_customer_payment_profile"], "customer_unique_id")
    # the order of an unknown customer has no unique id and is dropped
    assert set(p) == {"u1", "u2", "u3", "u4", "u5"}
    u1 = p["u1"]
    assert (u1.customer_state, u1.total_orders, u1.total_spend, u1.avg_order_value) == ("SP", 2, 720.51, 360.255)
    # o1: credit_card and voucher tie, the smaller name wins; both orders then agree
    assert (u1.preferred_payment_type, u1.credit_card_orders, u1.voucher_orders) == ("credit_card", 2, 1)
    assert (u1.avg_installments, u1.max_installments_used, u1.installment_bucket) == (10.5, 13, "12+")
    # mean of the means per customer id: (4.5 + 1) / 2, not the mean of the three reviews
    assert u1.avg_review_score == 2.75
    # the canceled order gives u2 no spend, but its review counts
    assert (p["u2"].total_orders, p["u2"].total_spend, p["u2"].avg_review_score) == (1, 21.1, 3.0)
    # completed order without payment
    u3 = p["u3"]
    assert (u3.total_spend, u3.avg_order_value, u3.preferred_payment_type, u3.installment_bucket) == (0.0, None, "unknown", "1")
    # spends 0, 21.1, 30, 40, 720.51: the quantile 0.75 is exactly 40, and 40 reaches it
    assert {k: r.is_high_value for k, r in p.items()} == {"u1": 1, "u2": 0, "u3": 0, "u4": 0, "u5": 1}
    assert p["u5"].preferred_payment_type == "boleto"


def test_order_detail(built):
    d = by(built[0]["mart_order_payment_detail"], "order_id")
    assert len(d) == 8
    assert (d["o1"].total_order_value, d["o1"].total_payment_value, d["o1"].num_items) == (210.51, 210.51, 2)
    assert (d["o5"].payment_type, d["o5"].total_payment_value, d["o5"].num_items, d["o5"].payment_installments) == ("unknown", 0.0, 0, 0)
    assert (d["o8"].customer_unique_id, d["o8"].customer_state, d["o8"].product_categories) == ("", "", "")


def test_geo_shares_are_true_shares(built):
    g = by(built[0]["mart_geo_payment_summary"], "customer_state")
    assert (g["SP"].total_customers, g["SP"].high_value_customers, g["SP"].credit_card_pct, g["SP"].boleto_pct) == (2, 1, 0.5, 0.5)
    assert g["SP"].high_value_revenue_share == pytest.approx(720.51 / 741.61)
    # u3 has no order value; the mean skips it
    assert g["MG"].avg_order_value == 35.0


def test_repeat_customer_keeps_the_greatest_state(built):
    r = by(built[0]["mart_repeat_customer"], "customer_unique_id")
    assert (r["u1"].customer_state, r["u1"].total_orders, r["u1"].is_repeat_customer, r["u1"].is_high_value) == ("SP", 1, 0, 1)
    assert r["u1"].first_order_date == dt.date(2017, 1, 5) and r["u1"].days_active == 0


def test_monthly_revenue_and_leakage(built):
    m = by(built[0]["mart_monthly_revenue"], "year_month", "payment_type")
    assert m["2017-03", "credit_card"].total_revenue == 510.0  # the canceled order is out
    assert m["2017-04", "unknown"].order_count == 2  # o5 and o8 have no payment
    leak = by(built[0]["mart_payment_leakage"], "state", "payment_type")
    national = (210.51 + 510 + 21.1 + 1000 + 0 + 30 + 40 + 0) / 8  # all statuses
    assert leak["SP", "boleto"].leakage_score == pytest.approx((national - 21.1) / national)
    assert leak["SP", "credit_card"].leakage_score == 0.0  # above the mean
    assert leak["SP", "boleto"].analysis_date == dt.date(2018, 5, 1)


def test_category_preference(built):
    c = by(built[0]["mart_hv_category_preference"], "customer_unique_id", "product_category_en")
    assert {k: (r.order_count, r.total_spend) for k, r in c.items()} == {
        ("u1", "watches_gifts"): (2, 550.0),
        ("u1", "sem_traducao"): (1, 150.01),  # no translation: the original name
        ("u5", "unknown"): (1, 40.0),  # no such product
    }


def test_seller_performance(built):
    s = by(built[0]["mart_seller_performance"], "seller_id")
    s1 = s["s1"]
    assert (s1.total_orders, s1.total_items_sold, s1.total_revenue, s1.unique_categories) == (2, 3, pytest.approx(220.11), 3)
    assert s1.avg_order_value == pytest.approx(220.11 / 3)  # mean item price
    assert s1.avg_review_score == pytest.approx((4.5 + 4.5 + 0) / 3)  # no review counts 0
    assert (s["s3"].seller_state, s["s3"].seller_city) == ("", "")


def test_price_range(built):
    p = by(built[0]["mart_product_price_range"], "year_month", "product_category_en", "price_bucket")
    assert p["2017-01", "watches_gifts", "A. 0-50"].order_count == 1
    assert p["2017-01", "sem_traducao", "C. 150-500"].avg_price == 150.01
    assert p["2017-03", "unknown", "A. 0-50"].total_revenue == 20.1
    assert not any(r.total_revenue == 999.0 for r in p.values())


def test_review_by_segment(built):
    s = by(built[0]["mart_review_by_segment"], "is_high_value", "payment_type", "customer_state")
    # o1 counts once per review
    cc = s[1, "credit_card", "SP"]
    assert (cc.total_reviews, cc.avg_review_score, cc.pct_5star, cc.pct_1star) == (2, 4.5, 50.0, 0.0)
    assert cc.avg_delivery_days == 3.0  # 3 days 23 hours
    late = s[1, "credit_card", "RJ"]
    assert (late.late_delivery_rate, late.avg_delivery_days, late.pct_1star) == (1.0, 25.0, 100.0)
    # undelivered: 0 days, not late; no review: score 0; canceled orders count here
    assert (s[0, "boleto", "SP"].avg_delivery_days, s[0, "boleto", "SP"].late_delivery_rate) == (0.0, 0.0)
    assert s[0, "credit_card", "SP"].avg_review_score == 3.0
    assert s[0, "unknown", "MG"].avg_review_score == 0.0


def test_lead_marts(built):
    a = by(built[0]["mart_seller_acquisition"], "mql_id")
    assert (a["m1"].days_to_close, a["m3"].days_to_close, a["m9"].days_to_close) == (10, -2, 0)
    assert (a["m3"].business_segment, a["m4"].lead_behaviour_profile, a["m4"].lead_type) == ("unknown",) * 3
    assert a["m9"].first_contact_date is None
    f = by(built[0]["mart_mql_funnel"], "origin")
    assert (f["unknown"].total_leads, f["unknown"].converted_leads, f["unknown"].conversion_rate) == (2, 2, 100.0)
    assert f["unknown"].avg_days_to_close == 20.0  # only positive days
    assert f["unknown"].top_business_segment == "pet"  # tie with unknown
    assert (f["paid_search"].conversion_rate, f["paid_search"].avg_days_to_close, f["paid_search"].top_business_segment) == (0.0, 0.0, "unknown")
    m = by(built[0]["mart_mql_monthly"], "year_month", "origin")
    assert (m["2018-02", "social"].total_leads, m["2018-02", "social"].conversion_rate) == (2, 50.0)
    b = by(built[0]["mart_lead_behaviour"], "lead_behaviour_profile")
    assert (b["cat"].total_deals, b["cat"].avg_days_to_close, b["cat"].top_business_segment) == (2, 5.0, "pet")
    assert b["eagle"].avg_declared_revenue == 1000.5


def test_refresh_is_idempotent_and_stamped(spark, built, tmp_path):
    df = built[0]["mart_mql_funnel"]
    M.write_mart(df, "mart_mql_funnel", str(tmp_path))
    again = M.write_mart(df, "mart_mql_funnel", str(tmp_path))
    assert again.count() == df.count()
    assert again.where("updated_at IS NULL").count() == 0


def test_latest_version_and_added_column(spark, built, tmp_path):
    name = "mart_customer_payment_profile"
    profile = built[0][name]
    stamp = lambda s: F.lit(s).cast("timestamp")
    older = M.publish(profile, name, stamp("2024-01-01 00:00:00")).drop("avg_review_score")
    older.write.parquet(f"{tmp_path}/{name}")
    newer = profile.where("customer_unique_id = 'u1'").withColumn("total_spend", F.lit(1.0))
    M.append_version(newer, name, str(tmp_path), stamp("2024-02-01 00:00:00"))
    got = by(M.read_latest(spark, name, str(tmp_path), {"avg_review_score": 0.0}), "customer_unique_id")
    assert len(got) == 5
    assert (got["u1"].total_spend, got["u1"].avg_review_score) == (1.0, 2.75)
    assert (got["u2"].total_spend, got["u2"].avg_review_score) == (21.1, 0.0)


def test_export_and_csv_round_trip(spark, built, tmp_path):
    names = ["mart_mql_monthly", "mart_payment_leakage"]
    done = M.export_marts([(n, built[0][n]) for n in names], M.parquet_writer(f"{tmp_path}/out"))
    assert done == names
    assert spark.read.parquet(f"{tmp_path}/out/mart_mql_monthly").count() == built[0]["mart_mql_monthly"].count()
    M.write_csv(built[0]["mart_payment_leakage"], f"{tmp_path}/csv")
    back = M.read_mart_csv(spark, "mart_payment_leakage", f"{tmp_path}/csv")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, built[0]["mart_payment_leakage"].collect()))
    lists = spark.createDataFrame([("x", [5, 7, 3])], "c string, n array<int>")
    M.write_csv(lists, f"{tmp_path}/lists")
    assert spark.read.csv(f"{tmp_path}/lists", header=True).first()["n"] == "[5, 7, 3]"


def test_quality_rules(spark, shop):
    raw = read_all_raw(spark, shop)
    assert validate(raw) == {"orders": 8, "order_payments": 8, "customers": 7}
    bad = {"orders": raw["orders"].where("false"), "order_payments": raw["order_payments"].withColumn("payment_value", -F.col("payment_value"))}
    rules = {"orders": default_rules()["orders"], "order_payments": [not_negative("payment_value"), not_null("order_id")]}
    report = {(r.table_name, r.rule): (r.violations, r.passed) for r in dq_report(bad, rules).collect()}
    assert report["orders", "not empty"] == (1, 0)
    assert report["order_payments", "payment_value not negative"] == (8, 0)
    assert report["order_payments", "order_id not null"] == (0, 1)
    with pytest.raises(ValueError, match="not empty.*payment_value not negative"):
        validate(bad, rules)
    custom = {"orders": [Rule("known status", ~F.col("order_status").isin("delivered", "shipped", "approved"))]}
    with pytest.raises(ValueError, match=r"known status \(1\)"):
        validate(raw, custom)


def _copy(shop, tmp_path, name, text):
    import shutil

    folder = tmp_path / "shop"
    shutil.copytree(shop, folder)
    (folder / f"{name}.csv").write_text(text((folder / f"{name}.csv").read_text()))
    return str(folder)


def test_gate_sees_blanks_in_the_csv(spark, shop, tmp_path):
    def blank(text):
        head, first, *rest = text.splitlines()
        return "\n".join([head, "," + first.split(",", 1)[1], *rest])

    folder = _copy(shop, tmp_path, "orders", blank)
    with pytest.raises(ValueError, match=r"orders: order_id not null \(1\)"):
        validate(read_all_typed(spark, folder))
    with pytest.raises(ValueError, match="order_id not null"):
        validate(read_all_raw(spark, folder))  # blank text after the repair
    with pytest.raises(ValueError, match="order_id not null"):
        run_daily(spark, folder, folder_store(f"{tmp_path}/out"))
    assert not (tmp_path / "out").exists()


def test_gate_sees_lines_that_cannot_be_read(spark, shop, tmp_path):
    folder = _copy(shop, tmp_path, "order_payments", lambda t: t.rstrip("\n") + "\no1,x,voucher,one,abc\n")
    report = {(r.table_name, r.rule): r.violations for r in dq_report(read_all_typed(spark, folder)).collect()}
    assert report["order_payments", "every line readable"] == 1 and report["orders", "every line readable"] == 0


def test_daily_run(spark, shop, tmp_path):
    from martloom.session import scratch_dir

    counts = run_daily(spark, shop, folder_store(f"{tmp_path}/marts"), M.parquet_writer(f"{tmp_path}/export"))
    assert counts == {"orders": 8, "order_payments": 8, "customers": 7}
    names = sorted(name for step in STEPS for name in step)
    assert sorted(p.name for p in (tmp_path / "export").iterdir()) == names
    left = [p for p in Path(scratch_dir(spark).removeprefix("file:")).glob("run-*")]
    assert left == []  # what the run wrote in between is gone


def test_equal_stamps_are_decided_by_the_last_append(spark, built, tmp_path):
    name = "mart_repeat_customer"
    repeat = built[0][name]
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp")
    M.publish(repeat, name, stamp).write.parquet(f"{tmp_path}/{name}")
    for days in (5, 3, 9, 7):
        M.append_version(repeat.withColumn("days_active", F.lit(days)), name, str(tmp_path), stamp)
    got = M.read_latest(spark, name, str(tmp_path))
    assert {r.days_active for r in got.collect()} == {7} and got.count() == repeat.count()


def test_one_file_per_bucket(spark, tmp_path):
    df = spark.range(500).select(
        F.col("id").cast("string").alias("customer_unique_id"), F.lit("SP").alias("customer_state"), F.lit(1).cast("bigint").alias("total_orders"),
        F.lit(0).alias("is_repeat_customer"), F.current_date().alias("first_order_date"), F.current_date().alias("last_order_date"),
        F.lit(0).alias("days_active"), F.lit(0).alias("is_high_value"),
    ).repartition(6)
    for database in ("shop_a", "shop_b"):  # two folders do not share a catalog entry
        M.write_bucketed(df, "mart_repeat_customer", f"{tmp_path}/{database}", "customer_unique_id", 8, database)
        assert len(list((tmp_path / database / "mart_repeat_customer").glob("part-*"))) == 8
    assert spark.table("shop_a.mart_repeat_customer").count() == spark.table("shop_b.mart_repeat_customer").count() == 500
    for database in ("shop_a", "shop_b"):
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_files_without_line_breaks_are_split(spark, tmp_path):
    spark.range(20000).selectExpr("id", "repeat('x', 40) AS t").coalesce(1).write.csv(f"{tmp_path}/c", header=True)
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        assert read_csv(spark, f"{tmp_path}/c", "id long, t string").rdd.getNumPartitions() > 4
        assert read_csv(spark, f"{tmp_path}/c", "id long, t string", line_breaks=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)


def test_nan_in_typed_inputs_counts_as_missing(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, 1.5)], "id int, price double")
    assert [r.price for r in Marts({"x": df}, cut).raw["x"].orderBy("id").collect()] == [None, None, 1.5]


def test_shuffle_partitions_are_bounded():
    from martloom.session import shuffle_partitions

    assert shuffle_partitions(100 * 10**12, 4000) == 20_000
    assert shuffle_partitions(10**12, 4000) == 7451
    assert shuffle_partitions(5_000, 8) == 8


def test_input_bytes_are_those_of_the_files(spark, tmp_path):
    from martloom.session import input_bytes

    spark.range(1000).write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    size = sum(p.stat().st_size for p in (tmp_path / "t").glob("*.parquet"))
    assert input_bytes([t, t.join(t.withColumnRenamed("id", "k"), F.expr("id = k"))]) == 3 * size


def test_bucketed_customer_marts_join_without_shuffle(spark, shop, tmp_path):
    marts = Marts(read_all_raw(spark, shop), bucketed_store(str(tmp_path), 4), Config(), cut=cut)
    profile, repeat = marts.mart("mart_customer_payment_profile"), marts.mart("mart_repeat_customer")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = profile.join(repeat, "customer_unique_id")
        assert joined.count() == 5
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for name in ("mart_customer_payment_profile", "mart_repeat_customer"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_seller_plan_does_not_multiply_rows(spark, shop):
    marts = Marts(read_all_raw(spark, shop), cut, Config(), cut=cut)
    assert "Expand" not in marts.define("mart_seller_performance")._jdf.queryExecution().executedPlan().toString()


def test_customer_quantiles_are_found_once(spark, shop):
    marts = Marts(read_all_raw(spark, shop), cut, Config(), cut=cut)
    first = marts.part("customer_quantiles")
    assert first is marts.part("customer_quantiles") and first.count() == 1
