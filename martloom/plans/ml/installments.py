"""Installment recommendation: logistic model on customer profiles, decision rules on top."""

from __future__ import annotations

import math
from multiprocessing.pool import ThreadPool
from statistics import fmean, pstdev

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import ElementwiseProduct, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.config import CONFIDENCE_REASONS, CONFIDENCE_TIERS, OVERRIDE_REASON_BATCH, OVERRIDE_REASON_CHECKOUT, Config
from martloom.functions.numbers import half_even, is_true, lookup, tier
from martloom.functions.text import fill
from martloom.operators.dense import dense_levels
from martloom.operators.quantiles import exact_quantile
from martloom.operators.ranking import stratified_fold

FEATURES = ["state_encoded", "log_avg_order_value", "log_total_orders", "is_credit_card", "is_high_value", "leakage_state"]
TARGET = "uses_installments"


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def fit_features(profile: DataFrame, cfg: Config = Config()) -> PipelineModel:
    """Feature stages, fitted: state index in alphabetical order, logs, flags, vector.

    A state not seen in training counts as the default state, a missing order value as the
    training median. Both become constants of the saved pipeline, so batch and stream agree. The index holds every
    value of ``customer_state``, which has to be a state: some dozens of values, not a free text.
    """
    known = profile.select(F.coalesce("customer_state", F.lit(cfg.default_state)).alias("_state"))
    indexer = StringIndexer(inputCol="_state", outputCol="state_encoded", stringOrderType="alphabetAsc").fit(known)
    median = exact_quantile(profile, "avg_order_value", 0.5).first()[0]
    fallback = cfg.default_state if cfg.default_state in indexer.labels else indexer.labels[0]
    columns = SQLTransformer(
        statement=f"""
        SELECT *,
          CASE WHEN customer_state IN ({_quoted(indexer.labels)}) THEN customer_state ELSE {_quoted([fallback])} END AS _state,
          log1p(coalesce(avg_order_value, {float(median)!r}D)) AS log_avg_order_value,
          log1p(coalesce(total_orders, 1)) AS log_total_orders,
          CAST(coalesce(preferred_payment_type = 'credit_card', false) AS INT) AS is_credit_card,
          CAST(coalesce(customer_state IN ({_quoted(cfg.frontier_states)}), false) AS INT) AS leakage_state
        FROM __THIS__"""
    )
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="raw_features")
    return PipelineModel(stages=[columns, indexer, assembler])


def installment_features(profile: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Unscaled model inputs per customer."""
    ready = fit_features(profile, cfg).transform(profile)
    return ready.select("customer_unique_id", F.col("state_encoded").cast("int").alias("state_encoded"), *FEATURES[1:], TARGET)


def _scaled(profile: DataFrame, cfg: Config) -> tuple[PipelineModel, int]:
    """Feature stages plus scaling by the population deviation (Spark's scaler uses the sample one)."""
    features = fit_features(profile, cfg)
    vectors = features.transform(profile).select("raw_features")
    scaler = StandardScaler(inputCol="raw_features", outputCol="scaled", withMean=True, withStd=True).fit(vectors)
    n = profile.count()
    widen = ElementwiseProduct(
        inputCol="scaled", outputCol="features", scalingVec=Vectors.dense([math.sqrt(n / max(n - 1, 1))] * len(FEATURES))
    )
    return PipelineModel(stages=[*features.stages, scaler, widen]), n


def _logistic(rows: int) -> LogisticRegression:
    # mean loss plus |w|^2 / (2 n) is the unit-strength penalty of the summed loss
    return LogisticRegression(
        featuresCol="features",
        labelCol=TARGET,
        regParam=1.0 / rows,
        elasticNetParam=0.0,
        standardization=False,
        maxIter=500,
        tol=1e-10,
    )


def train_installment_model(profile: DataFrame, cfg: Config = Config()) -> PipelineModel:
    """Fitted pipeline from profile columns to probability; saved and loaded as any pipeline model."""
    scaling, n = _scaled(profile, cfg)
    rows = scaling.transform(profile).select("features", TARGET).persist()
    try:
        return PipelineModel(stages=[*scaling.stages, _logistic(n).fit(rows)])
    finally:
        rows.unpersist()


def _confusion(scored: DataFrame):
    hit, said = F.col(TARGET) == 1, F.col("prediction") == 1
    return scored.agg(
        F.count_if(hit & said).alias("tp"),
        F.count_if(~hit & said).alias("fp"),
        F.count_if(hit & ~said).alias("fn"),
        F.count_if(~hit & ~said).alias("tn"),
    ).first()


def _ratio(a: float, b: float) -> float:
    return a / b if b else 0.0


def installment_model_metrics(profile: DataFrame, cfg: Config = Config(), key: str = "customer_unique_id") -> DataFrame:
    """Stratified cross-validation: mean and deviation of accuracy, AUC and F1."""
    scaling, _ = _scaled(profile, cfg)
    vectors = scaling.transform(profile).select(key, "features", TARGET)
    rows = stratified_fold(vectors, key, TARGET, cfg.folds, cfg.seed).persist()
    auc = BinaryClassificationEvaluator(labelCol=TARGET, metricName="areaUnderROC")

    def held_out(fold: int):
        train = rows.where(F.col("fold") != fold)
        scored = _logistic(train.count()).fit(train).transform(rows.where(F.col("fold") == fold))
        c = _confusion(scored)
        total = c.tp + c.fp + c.fn + c.tn
        return _ratio(c.tp + c.tn, total), auc.evaluate(scored), _ratio(2 * c.tp, 2 * c.tp + c.fp + c.fn)

    try:
        with ThreadPool(cfg.folds) as pool:
            folds = pool.map(held_out, range(cfg.folds))
    finally:
        rows.unpersist()
    values = []
    for i, name in enumerate(("accuracy", "auc", "f1")):
        scores = [f[i] for f in folds]
        values += [(f"{name}_mean", fmean(scores)), (f"{name}_std", pstdev(scores))]
    return profile.sparkSession.createDataFrame(values, "metric string, value double")


def installment_report(profile: DataFrame, model: PipelineModel) -> DataFrame:
    """Precision, recall, F1 and support per class on the training rows, then accuracy, macro and weighted averages."""
    c = _confusion(model.transform(profile))

    def row(label: str, hit: int, wrong: int, missed: int):
        p, r = _ratio(hit, hit + wrong), _ratio(hit, hit + missed)
        return label, p, r, _ratio(2 * p * r, p + r), hit + missed

    rows = [row("No installments", c.tn, c.fn, c.fp), row("Uses installments", c.tp, c.fp, c.fn)]
    total = sum(r[4] for r in rows)
    right = _ratio(c.tp + c.tn, total)
    macro = [fmean(r[i] for r in rows) for i in (1, 2, 3)]
    weighted = [_ratio(sum(r[i] * r[4] for r in rows), total) for i in (1, 2, 3)]
    averages = [("accuracy", right, right, right, total), ("macro avg", *macro, total), ("weighted avg", *weighted, total)]
    return profile.sparkSession.createDataFrame(
        rows + averages, "class string, precision double, recall double, f1 double, support bigint"
    )


def installment_coefficients(model: PipelineModel, spark) -> DataFrame:
    logistic: LogisticRegressionModel = model.stages[-1]
    rows = sorted(
        ((name, float(w), abs(float(w))) for name, w in zip(FEATURES, logistic.coefficients)), key=lambda r: -r[2]
    )
    return spark.createDataFrame(rows, "feature string, coefficient double, abs_coef double")


def override_rule(cfg: Config) -> Column:
    """Leakage state, credit card and an order above the threshold."""
    return is_true(
        F.col("customer_state").isin(*cfg.frontier_states)
        & (F.col("preferred_payment_type") == "credit_card")
        & (F.col("avg_order_value") > cfg.hvc_spend_threshold)
    )


def final_decision(rule_flag: Column, confidence: Column) -> Column:
    """Recommend when the rule fires and the model leans that way, or when the model is sure."""
    return (rule_flag & (confidence > 0.5)) | (confidence > 0.75)


def recommend(scored: DataFrame, probability: Column, cfg: Config = Config()) -> DataFrame:
    """Tier, reason and confidence per customer from a probability column, with the rule on top."""
    override = override_rule(cfg)
    floor = CONFIDENCE_TIERS[0][0]
    rounded = half_even(probability, 4)
    model_tier = tier(probability, CONFIDENCE_TIERS)
    return scored.select(
        "customer_unique_id",
        "customer_state",
        "total_spend",
        "is_high_value",
        "preferred_payment_type",
        "installment_bucket",
        "avg_order_value",
        F.when(override, F.greatest(rounded, F.lit(floor))).otherwise(rounded).alias("installment_confidence"),
        F.when(override, CONFIDENCE_TIERS[0][1]).otherwise(model_tier).alias("recommended_tier"),
        F.when(override, OVERRIDE_REASON_BATCH).otherwise(lookup(model_tier, CONFIDENCE_REASONS)).alias("recommendation_reason"),
        final_decision(override, probability).alias("final_recommend"),
    )


def installment_recommendations(profile: DataFrame, model: PipelineModel, cfg: Config = Config()) -> DataFrame:
    return recommend(model.transform(profile), vector_to_array("probability")[1], cfg)


def score_checkouts(events: DataFrame, model: PipelineModel, cfg: Config = Config()) -> DataFrame:
    """Recommendation per checkout event; the same call serves a batch and a stream.

    Columns read: customer_state, avg_order_value (the current order), total_orders,
    preferred_payment_type, is_high_value. All other columns pass through in front.
    """
    return decide(model.transform(events).withColumn("_p", vector_to_array("probability")[1]), events.columns, cfg)


def decide(scored: DataFrame, columns: list[str], cfg: Config = Config()) -> DataFrame:
    """The rules behind a probability ``_p``; ``columns`` are those of the event."""
    override = override_rule(cfg)
    floor = CONFIDENCE_TIERS[0][0]
    p = F.col("_p")
    model_tier = tier(p, CONFIDENCE_TIERS)
    chosen = F.when(override, CONFIDENCE_TIERS[0][1]).otherwise(model_tier)
    reason = fill(OVERRIDE_REASON_CHECKOUT, state=F.col("customer_state"), threshold=f"{cfg.hvc_spend_threshold:.2f}")
    kept = [c for c in columns if c not in ("customer_state", "avg_order_value")]
    return scored.select(
        *kept,
        "customer_state",
        F.col("avg_order_value").alias("order_value"),
        (chosen != "1").alias("recommend_installments"),
        chosen.alias("recommended_tier"),
        half_even(F.when(override, F.greatest(p, F.lit(floor))).otherwise(p), 4).alias("confidence_score"),
        F.when(override, reason).otherwise(lookup(model_tier, CONFIDENCE_REASONS)).alias("reason"),
    )


def installment_tier_distribution(recommendations: DataFrame) -> DataFrame:
    """Customers per recommended tier, all tiers listed, with how many the rule decided."""
    counts = recommendations.groupBy(F.col("recommended_tier").alias("tier")).agg(
        F.count("*").alias("n"), F.count_if(F.col("recommendation_reason") == OVERRIDE_REASON_BATCH).alias("o")
    )
    total = F.sum(F.coalesce("n", F.lit(0))).over(Window.partitionBy())
    return dense_levels(counts, "tier", [label for _, label in CONFIDENCE_TIERS]).select(
        F.col("tier").alias("recommended_tier"),
        F.coalesce("n", F.lit(0)).alias("customer_count"),
        half_even(F.coalesce("n", F.lit(0)) / F.nullif(total, F.lit(0)) * 100, 1).alias("pct"),
        F.coalesce("o", F.lit(0)).alias("override_count"),
    )
