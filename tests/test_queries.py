"""Every registered query against its SQL oracle on the smallest test tables, and plan shapes that must hold at scale."""

import os
from dataclasses import replace

import compare
import pytest
from pyspark.ml import PipelineModel

import __spark_entry__ as contract
import registry
from martloom.plans.analytics import write_reports
from martloom.plans.marts import customers, orders
from martloom.plans.marts.common import payments_by_order, reviews_by_order
from martloom.plans.ml import jobs
from martloom.plans.pipeline import Marts
from martloom.session import cut

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

SLOW = {"lead_regressor", "lead_conversion_classifier"}


@pytest.fixture(scope="module")
def con():
    return compare.oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_oracle(spark, con, name):
    verdict = compare.compare(name, contract.queries()[name](spark, SF), con, contract.oracle_sql()[name])
    assert verdict.startswith("ok"), verdict


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql()) - SLOW))
def test_query_without_oracle_returns_rows(spark, name):
    assert contract.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert {"state", "payment_type", "severity", "remediation"} <= set(df.columns)
    assert df.count() > 0


def test_reports_and_model_runs_write_their_results(spark, tmp_path):
    m = registry.marts(spark, SF)
    names = ["channel_efficiency", "leakage_alerts", "customer_points", "category_timing"]
    assert write_reports(m, str(tmp_path), names) == names
    alerts = spark.read.csv(f"{tmp_path}/leakage_alerts", header=True, inferSchema=True).collect()
    assert [r.alert_rank for r in alerts] == list(range(1, len(alerts) + 1))
    quick = Marts(m.raw, cut, replace(m.cfg, boosting_rounds=3, folds=2, cluster_range=(2, 3)), cut=cut)
    done = jobs.run_lead_scoring(quick, str(tmp_path), cut) + jobs.run_seller_tiers(quick, str(tmp_path), cut)
    done += jobs.run_installments(quick, str(tmp_path), cut)
    for name in done:
        assert spark.read.csv(f"{tmp_path}/{name}", header=True).count() > 0, name
    assert PipelineModel.load(f"{tmp_path}/models/installments").stages


def hot_shop(spark):
    """One customer and one order hold a third of all rows."""
    n = 60_000
    base = spark.range(n).selectExpr("id AS order_id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS customer_id").selectExpr(
        "*", "'delivered' AS order_status", "timestamp_ntz'2024-01-01 00:00:00' AS order_purchase_timestamp", "repeat('x', 50) AS pad"
    )
    people = spark.range(n).selectExpr("id AS customer_id", "id % 1000 AS customer_unique_id", "'SP' AS customer_state", "'x' AS customer_city")
    payments = spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 5 ELSE id END AS order_id", "1 AS payment_installments", "double(1.25) AS payment_value",
        "CASE WHEN id % 2 = 0 THEN 'boleto' ELSE 'voucher' END AS payment_type",
    )
    items = payments.selectExpr("order_id", "payment_value AS price", "double(0) AS freight_value")
    reviews = payments.selectExpr("order_id", "4 AS review_score")
    return base, people, payments, items, reviews


def test_hot_customer_is_split(spark):
    base, people, payments, items, _ = hot_shop(spark)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        detail = orders.order_payment_detail(base, payments_by_order(payments), people, items)
        rows = detail.collect()
        plan = detail._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        assert len(rows) == 60_000
        hot = next(r for r in rows if r.order_id == 5)
        # 10,000 even and 10,000 odd payments moved to order 5, which has an odd one of its own
        assert (hot.num_items, hot.total_order_value, hot.payment_type) == (20_001, 25_001.25, "voucher")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_groups_shrink_before_the_shuffle(spark):
    """Every aggregate of the profile has a partial step, so a hot key sends one row per task."""
    base, people, payments, _, reviews = hot_shop(spark)
    profile = customers.customer_payment_profile(base, payments_by_order(payments), people, reviews_by_order(reviews))
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "partial_mode" in plan and "partial_sum" in plan
    row = profile.where("customer_unique_id = 7").first()
    # the hot customer, and the few others with the same unique id
    assert row.total_orders == 20_000 + sum(1 for i in range(7, 60_000, 1000) if i % 3)
