"""Models: agreement with direct solutions, invariants, persistence, stream equal to batch."""

import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from martloom.config import OVERRIDE_REASON_BATCH, Config
from martloom.plans.ml import installments, leads, sellers
from martloom.session import cut, scratch_dir
from martloom.streaming import checkout

QUICK = replace(Config(), boosting_rounds=4, folds=2)


@pytest.fixture(scope="module")
def profile(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        value, card = rng.lognormvariate(5, 0.8), rng.random() < 0.6
        y = rng.random() < 1 / (1 + np.exp(-(-4 + 0.6 * np.log1p(value) + 1.5 * card)))
        rows.append(
            (f"u{i}", rng.choice(["SP", "RJ", "BA", "AC", None]), value if i % 50 else None, rng.randint(1, 4),
             "credit_card" if card else "boleto", int(value > 180), int(y), value, "1")
        )
    return spark.createDataFrame(
        rows,
        "customer_unique_id string, customer_state string, avg_order_value double, total_orders bigint, "
        "preferred_payment_type string, is_high_value int, uses_installments int, total_spend double, installment_bucket string",
    ).repartition(3)


@pytest.fixture(scope="module")
def model(profile):
    return installments.train_installment_model(profile)


def newton(x, y):
    """Unit-strength L2 logistic regression with a free intercept."""
    x1 = np.column_stack([x, np.ones(len(x))])
    penalty = np.diag([1.0] * x.shape[1] + [0.0])
    w = np.zeros(x1.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x1 @ w))
        w -= np.linalg.solve(x1.T @ (x1 * (p * (1 - p))[:, None]) + penalty, x1.T @ (p - y) + penalty @ w)
    return w


def test_features(profile):
    f = {r.customer_unique_id: r for r in installments.installment_features(profile).collect()}
    p = {r.customer_unique_id: r for r in profile.collect()}
    states = sorted({"SP", "RJ", "BA", "AC"})
    median = np.median([r.avg_order_value for r in p.values() if r.avg_order_value is not None])
    for k, r in p.items():
        assert f[k].state_encoded == states.index(r.customer_state or "SP")
        assert f[k].log_avg_order_value == pytest.approx(np.log1p(median if r.avg_order_value is None else r.avg_order_value))
        # a missing state is the default for the index, but no leakage state
        assert f[k].leakage_state == int(r.customer_state in ("SP", "RJ"))


def test_coefficients_equal_a_direct_solution(spark, profile, model):
    rows = installments.installment_features(profile).collect()
    x = np.array([[r[c] for c in installments.FEATURES] for r in rows], float)
    y = np.array([r.uses_installments for r in rows], float)
    w = newton((x - x.mean(0)) / x.std(0), y)
    got = {r.feature: r.coefficient for r in installments.installment_coefficients(model, spark).collect()}
    assert [got[c] for c in installments.FEATURES] == pytest.approx(list(w[:-1]), abs=1e-5)
    sizes = [r.abs_coef for r in installments.installment_coefficients(model, spark).collect()]
    assert sizes == sorted(sizes, reverse=True)


def test_metrics_and_report(profile, model):
    m = {r.metric: r.value for r in installments.installment_model_metrics(profile, QUICK).collect()}
    assert set(m) == {f"{a}_{b}" for a in ("accuracy", "auc", "f1") for b in ("mean", "std")}
    assert 0.5 < m["auc_mean"] < 1 and 0.5 < m["accuracy_mean"] < 1
    report = installments.installment_report(profile, model).collect()
    assert sum(r.support for r in report[:2]) == 400
    by = {r["class"]: r for r in report}
    no, yes = by["No installments"], by["Uses installments"]
    assert by["macro avg"].f1 == pytest.approx((no.f1 + yes.f1) / 2)
    assert by["weighted avg"].recall == pytest.approx(by["accuracy"].f1)
    assert by["accuracy"].support == by["weighted avg"].support == 400


def test_recommendation_rules(spark):
    rows = [("a", "BA", 0.8), ("b", "BA", 0.79999), ("c", "BA", 0.65), ("d", "BA", 0.5), ("e", "BA", 0.49999), ("f", "SP", 0.1), ("g", "SP", 0.9)]
    df = spark.createDataFrame(rows, "customer_unique_id string, customer_state string, p double").withColumns(
        {
            "total_spend": F.lit(1.0), "is_high_value": F.lit(0), "installment_bucket": F.lit("1"),
            "preferred_payment_type": F.lit("credit_card"), "avg_order_value": F.lit(200.0),
        }
    )
    got = {r.customer_unique_id: r for r in installments.recommend(df, F.col("p")).collect()}
    assert {k: r.recommended_tier for k, r in got.items()} == {"a": "12+", "b": "7-12", "c": "7-12", "d": "2-6", "e": "1", "f": "12+", "g": "12+"}
    # shown confidence is rounded, the tier is not
    assert (got["b"].installment_confidence, got["e"].installment_confidence) == (0.8, 0.5)
    assert (got["f"].installment_confidence, got["g"].installment_confidence) == (0.8, 0.9)
    assert got["f"].recommendation_reason == OVERRIDE_REASON_BATCH
    assert {k for k, r in got.items() if r.final_recommend} == {"a", "b", "g"}
    below = installments.recommend(df.withColumn("avg_order_value", F.lit(180.52)), F.col("p"))
    assert below.where(F.col("recommendation_reason") == OVERRIDE_REASON_BATCH).count() == 0
    tiers = {r.recommended_tier: r for r in installments.installment_tier_distribution(installments.recommend(df, F.col("p"))).collect()}
    assert (tiers["12+"].customer_count, tiers["12+"].override_count, tiers["12+"].pct) == (3, 2, 42.9)


def test_stream_equals_batch_with_a_reloaded_model(spark, model, tmp_path):
    path = f"{tmp_path}/model"
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    rows = [
        (f"o{i}", s, v, n, p, h)
        for i, (s, v, n, p, h) in enumerate(
            [("SP", 210.0, 1, "credit_card", 0), ("SP", 150.0, 3, "credit_card", 1), ("PB", 268.0, 1, "credit_card", 1),
             ("SC", 85.0, 1, "boleto", 0), ("RJ", 320.0, 5, "credit_card", 1), (None, None, None, None, 0)]
        )
    ]
    events = spark.createDataFrame(rows, checkout.CHECKOUT_SCHEMA)
    events.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = checkout.read_checkouts(spark, f"{tmp_path}/in", files_per_batch=1)
    assert stream.isStreaming
    checkout.start_scoring(stream, loaded, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()))
    batch = installments.score_checkouts(events, model)
    assert got == sorted(map(tuple, batch.collect()))
    by_id = {r.order_id: r for r in batch.collect()}
    assert by_id["o0"].recommended_tier == "12+" and by_id["o0"].confidence_score >= 0.8
    assert by_id["o0"].reason.startswith("LEAKAGE OVERRIDE: SP credit card order > R$180.52.")
    assert by_id["o1"].reason[:8] != "LEAKAGE "
    assert by_id["o3"].recommend_installments == (by_id["o3"].recommended_tier != "1")
    # a second run finds nothing new
    checkout.start_scoring(stream, loaded, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 6


@pytest.fixture(scope="module")
def deals(spark):
    rng = random.Random(8)
    rows = []
    for i in range(240):
        p = rng.choice(["cat", "eagle", "wolf", "unknown"])
        days = int({"cat": 20, "eagle": 10, "wolf": 90, "unknown": 50}[p] * rng.uniform(0.7, 1.3))
        rows.append((f"m{i}", f"s{i}", rng.choice(["pet", "toys"]), "online", p, "reseller", days - (i == 0) * 200, 0.0 if i % 4 else 500.0))
    return spark.createDataFrame(
        rows,
        "mql_id string, seller_id string, business_segment string, lead_type string, lead_behaviour_profile string, "
        "business_type string, days_to_close int, declared_monthly_revenue double",
    )


def test_lead_model(spark, deals, tmp_path):
    cfg = replace(QUICK, boosting_rounds=30, boosting_rate=0.2)
    assert leads.lead_features(deals).where("days_to_close < 0").count() == 0
    fitted = leads.train_lead_model(deals, cut, cfg)
    fitted.save(str(tmp_path))
    loaded = leads.LeadModel.load(spark, str(tmp_path))
    scores = leads.lead_scores(deals, loaded, deals, cut)
    assert sorted(scores.columns)[:3] == ["business_segment", "business_type", "days_to_close"]
    rows = scores.collect()
    assert len(rows) == 240
    assert (max(r.priority_score for r in rows), min(r.priority_score for r in rows)) == (1.0, 0.0)
    for r in rows:
        want = "LOW" if r.priority_score <= 0.4 else "MEDIUM" if r.priority_score <= 0.7 else "HIGH"
        assert r.priority_tier == want or min(abs(r.priority_score - e) for e in (0.4, 0.7)) < 1e-4
    summary = {r.lead_behaviour_profile: r for r in leads.lead_profile_summary(scores).collect()}
    assert summary["eagle"].avg_predicted_days < summary["wolf"].avg_predicted_days
    assert sum(r.lead_count for r in leads.lead_tier_distribution(scores).collect()) == 240
    top = leads.lead_top(scores).collect()
    assert len(top) == 10 and top[0].priority_score == 1.0
    importance = leads.feature_importance(loaded, cfg).orderBy("rank").collect()
    assert importance[0].feature == "lead_behaviour_profile" and len(importance) == 6
    metrics = {r.metric: r.value for r in leads.lead_model_metrics(loaded).collect()}
    assert metrics["insample_r2"] > 0.5 and metrics["cv_rmse_log_mean"] > 0


def test_conversion_classifier(spark, deals):
    mql = spark.range(600).select(
        F.concat(F.lit("m"), "id").alias("mql_id"), F.when(F.col("id") % 3 == 0, "").otherwise("social").alias("origin")
    )
    training = leads.conversion_training(mql, deals, QUICK)
    assert training.where("is_converted = 1").first().weight == pytest.approx(360 / 240)
    got = {r.feature_set: r for r in leads.conversion_classifier(mql, deals, cut, QUICK).collect()}
    assert got["all"].auprc == pytest.approx(1.0)  # the profile gives the label away
    assert got["origin"].auprc < 0.7 and got["origin"].auprc_std >= 0


def test_seller_clusters(spark, tmp_path):
    rng = random.Random(6)
    rows = [
        (f"s{g}-{i}", "SP", "x", n * rng.uniform(0.9, 1.1), n * 90 * rng.uniform(0.9, 1.1), 200.0 if i % 2 else 100.0, 3.0 + g * 0.5, 2 + 4 * g)
        for g, n in enumerate((5, 50, 500))
        for i in range(40)
    ]
    performance = spark.createDataFrame(
        [(a, b, c, int(d), e, f, g, h) for a, b, c, d, e, f, g, h in rows],
        "seller_id string, seller_state string, seller_city string, total_orders bigint, total_revenue double, "
        "avg_order_value double, avg_review_score double, unique_categories bigint",
    )
    fitted = sellers.train_seller_model(performance)
    fitted.save(str(tmp_path))
    tiers = sellers.seller_tiers(performance, sellers.SellerModel.load(str(tmp_path)))
    named = {r.seller_id: r for r in tiers.collect()}
    for i in range(40):
        assert [named[f"s{g}-{i}"].revenue_tier for g in range(3)] == list(sellers.TIERS)
    one = named["s1-1"]
    assert (one.hvc_aligned, one.ad_credit_value) == (1, pytest.approx(3.5 * 100 * one.total_orders * 1.3 * 0.1))
    centroids = {r.revenue_tier: r for r in sellers.seller_tier_centroids(tiers).collect()}
    revenue = [r[4] for r in rows[:40]]
    assert centroids["Starter"].median_revenue == pytest.approx(np.median(revenue), abs=0.06)
    assert centroids["Growth"].pct_sellers == 33.3
    assert len(sellers.seller_top(tiers).collect()) == 10
    check = {r.k: r for r in sellers.cluster_validation(performance).collect()}
    assert check[3].is_best == 1 and check[3].inertia < check[2].inertia
    # inertia on features scaled by the population deviation, from the assignment itself
    x = np.array([[np.log1p(r[4]), r[6], np.log1p(int(r[3])), r[7]] for r in rows])
    z = (x - x.mean(0)) / x.std(0)
    labels = np.repeat([0, 1, 2], 40)
    want = sum(((z[labels == g] - z[labels == g].mean(0)) ** 2).sum() for g in range(3))
    assert check[3].inertia == pytest.approx(want, abs=0.01)


class Session:
    """Just the settings :func:`scratch_dir` reads."""

    def __init__(self, master, named):
        self.master, self.named, self.conf, self.sparkContext = master, named, self, self

    def get(self, key, default=None):
        return self.named if key == "spark.checkpoint.dir" and self.named else default

    def getCheckpointDir(self):
        return None


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_dir(spark) == scratch_dir(spark)
    assert scratch_dir(Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Session("yarn", None))


def test_checkout_of_a_new_customer(spark):
    from martloom.streaming.checkout import checkout_events

    detail = spark.createDataFrame(
        [("o1", "known", "SP", 10.0, "boleto"), ("o2", "new", "SP", 20.0, "credit_card")],
        "order_id string, customer_unique_id string, customer_state string, total_payment_value double, payment_type string",
    )
    profile = spark.createDataFrame([("known", 4, 1)], "customer_unique_id string, total_orders bigint, is_high_value int")
    got = {r.order_id: (r.total_orders, r.is_high_value) for r in checkout_events(detail, profile).collect()}
    assert got == {"o1": (4, 1), "o2": (1, 0)}
