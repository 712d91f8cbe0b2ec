"""Lead scoring: days-to-close regression, scores and reports, and a conversion classifier."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from statistics import fmean, pstdev

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.config import LEAD_PACKAGE_BANDS, PRIORITY_BANDS, Config
from martloom.functions.aggregates import exact_mean, most_frequent, pct
from martloom.functions.numbers import band, blank_to_unknown, half_even
from martloom.operators.boosting import Boosting, Fit, Trees, boost
from martloom.operators.encoding import apply_mapping, encode_out_of_fold, target_mapping
from martloom.operators.ranking import hash_fold, numbered, rank_rows, share_of_total

CATEGORIES = ["lead_type", "lead_behaviour_profile", "business_segment", "business_type"]
FEATURES = [f"{c}_enc" for c in CATEGORIES] + ["log_revenue", "has_revenue"]
KEY = "mql_id"

Cut = Callable[[DataFrame, str], DataFrame]


def _feature_columns() -> list:
    revenue = F.coalesce("declared_monthly_revenue", F.lit(0.0))
    return [
        F.greatest("days_to_close", F.lit(0)).alias("days_to_close"),
        *[blank_to_unknown(c).alias(c) for c in CATEGORIES],
        F.log1p(revenue).alias("log_revenue"),
        (revenue > 0).cast("int").alias("has_revenue"),
    ]


def lead_features(acquisition: DataFrame) -> DataFrame:
    """Closing days floored at 0, log revenue, a declared-revenue flag, and categories without gaps."""
    return acquisition.select(KEY, *_feature_columns())


def encoded_leads(acquisition: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Training rows: every category encoded by the closing days of the other folds."""
    rows = lead_features(acquisition).withColumn("fold", hash_fold(KEY, cfg.folds, cfg.seed))
    return encode_out_of_fold(rows, CATEGORIES, "days_to_close", "fold", cfg.encoding_smoothing)


def lead_encodings(acquisition: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Category encodings from all rows, for scoring new leads."""
    return target_mapping(lead_features(acquisition), CATEGORIES, "days_to_close", cfg.encoding_smoothing)


def _boosting(cfg: Config, logistic: bool = False) -> Boosting:
    return Boosting(
        rounds=cfg.boosting_rounds,
        depth=cfg.boosting_depth,
        rate=cfg.boosting_rate,
        row_share=cfg.boosting_row_share,
        feature_share=cfg.boosting_feature_share,
        min_weight=cfg.boosting_min_rows,
        l1=cfg.boosting_l1,
        l2=cfg.boosting_l2,
        seed=cfg.seed,
        logistic=logistic,
    )


@dataclass
class LeadModel:
    """``checked``: label, days_to_close, fold, the model's own prediction and that of the fit that left the fold out."""

    trees: Trees
    encodings: DataFrame
    mean_days: float
    training: DataFrame
    checked: DataFrame

    def save(self, path: str) -> None:
        spark = self.encodings.sparkSession
        self.trees.save(spark, f"{path}/trees")
        for name in ("encodings", "training", "checked"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")
        meta = json.dumps({"mean_days": self.mean_days, "features": FEATURES})
        spark.createDataFrame([(meta,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LeadModel:
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        read = {name: spark.read.parquet(f"{path}/{name}") for name in ("encodings", "training", "checked")}
        return LeadModel(Trees.load(spark, f"{path}/trees"), mean_days=meta["mean_days"], **read)


def train_lead_model(acquisition: DataFrame, cut: Cut, cfg: Config = Config()) -> LeadModel:
    """Fit on log days; the fits of the cross-validation grow along with the model, in the same passes."""
    encoded = encoded_leads(acquisition, cfg).withColumn("label", F.log1p("days_to_close"))
    training = cut(encoded.withColumn("cv_fold", hash_fold(KEY, cfg.folds, cfg.seed + 1)), "lead-training")
    encodings = cut(lead_encodings(acquisition, cfg), "lead-encodings")
    mean_days = training.agg(F.avg("days_to_close")).first()[0]
    every = tuple(range(len(FEATURES)))
    fits = [Fit(every), *(Fit(every, fold) for fold in range(cfg.folds))]
    fitted = boost(training, FEATURES, "label", KEY, fits, _boosting(cfg), cut, "cv_fold", keep=["days_to_close"])
    checked = fitted.rows.select(
        "label", "days_to_close", "fold", F.col("predictions")[0].alias("own"), F.get("predictions", F.col("fold") + 1).alias("held_out")
    )
    return LeadModel(fitted.trees[0], encodings, mean_days, training, cut(checked, "lead-checked"))


def _error_columns(actual, predicted) -> list:
    """Root mean square error, mean absolute error and R2 of one prediction column."""
    error = actual - predicted
    return [
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.sum(error * error) / F.nullif(F.var_pop(actual) * F.count(actual), F.lit(0.0))).alias("r2"),
    ]


def lead_model_metrics(model: LeadModel) -> DataFrame:
    """Cross-validated error on the log scale and in-sample error in days, from the predictions made while training."""
    # one small row per fold comes back
    folds = model.checked.groupBy("fold").agg(*_error_columns(F.col("label"), F.col("held_out"))).orderBy("fold").collect()
    days = model.checked.agg(*_error_columns(F.col("days_to_close"), F.expm1("own"))).first()
    values = {
        "cv_rmse_log_mean": fmean(f.rmse for f in folds),
        "cv_rmse_log_std": pstdev(f.rmse for f in folds),
        "cv_r2_mean": fmean(f.r2 for f in folds),
        "cv_r2_std": pstdev(f.r2 for f in folds),
        "insample_rmse_days": days.rmse,
        "insample_mae_days": days.mae,
        "insample_r2": days.r2,
    }
    spark = model.checked.sparkSession
    return spark.createDataFrame([(k, float(v)) for k, v in values.items()], "metric string, value double")


def feature_importance(model: LeadModel, cfg: Config = Config()) -> DataFrame:
    """How much the error grows when one feature is taken from another lead.

    Every lead borrows from the one half the table further in hash order: one join serves
    all features, and no global shuffle of single columns is needed.
    """
    rows = numbered(model.training, KEY, cfg.seed, "_i")
    n = model.training.count()
    donors = rows.select(
        F.pmod(F.col("_i") + n // 2, F.lit(n)).alias("_i"), *[F.col(f).alias(f"{f}_d") for f in FEATURES]
    )
    scored = rows.join(donors, "_i")
    variants = [("base", FEATURES)] + [(f, [f"{g}_d" if g == f else g for g in FEATURES]) for f in FEATURES]
    for name, columns in variants:
        scored = model.trees.predict(scored, f"p_{name}", columns)
    errors = scored.agg(
        *[F.sqrt(F.avg((F.col("label") - F.col(f"p_{name}")) ** 2)).alias(name) for name, _ in variants]
    )
    split = model.trees.importance()
    gains = [
        F.struct(
            F.lit(f.removesuffix("_enc")).alias("feature"),
            (F.col(f) - F.col("base")).alias("permutation_importance"),
            F.lit(float(split[i])).alias("split_importance"),
        )
        for i, f in enumerate(FEATURES)
    ]
    return rank_rows(
        errors.select(F.inline(F.array(*gains))), "rank", [F.desc("permutation_importance"), F.asc("feature")]
    )


def feature_attributions(model: LeadModel) -> DataFrame:
    """Per feature the mean size and the mean of what it adds to a lead's predicted log days, largest size first."""
    per_lead = model.trees.attribute(model.training.select(*FEATURES)).select("attributions")
    means = per_lead.agg(
        *[exact_mean(F.abs(F.col("attributions")[i])).alias(f"a{i}") for i in range(len(FEATURES))],
        *[exact_mean(F.col("attributions")[i]).alias(f"m{i}") for i in range(len(FEATURES))],
    )
    rows = [
        F.struct(F.lit(f.removesuffix("_enc")).alias("feature"), F.col(f"a{i}").alias("mean_abs"), F.col(f"m{i}").alias("mean"))
        for i, f in enumerate(FEATURES)
    ]
    return rank_rows(means.select(F.inline(F.array(*rows))), "rank", [F.desc("mean_abs"), F.asc("feature")])


def lead_scores(leads: DataFrame, model: LeadModel, history: DataFrame, cut: Cut) -> DataFrame:
    """Predicted days, inverse min-max priority, tier, likely segment and onboarding package per lead.

    The lead travels along as one column, so its features need no join back. Predictions are
    written once: the scale needs their range before any row can be scored.
    """
    features = apply_mapping(
        leads.select(F.struct(*leads.columns).alias("lead"), *_feature_columns()),
        model.encodings,
        CATEGORIES,
        F.lit(model.mean_days),
    )
    days = F.greatest(F.expm1("prediction"), F.lit(0.0))
    predicted = cut(
        model.trees.predict(features).select("lead", "lead_behaviour_profile", days.alias("days")),
        "lead-predictions",
    )
    return priorities(predicted, history)


def priorities(predicted: DataFrame, history: DataFrame) -> DataFrame:
    """The rules behind predicted ``days``: ``lead`` (a struct), ``lead_behaviour_profile`` and ``days`` in."""
    low, high = (predicted.agg(f("days")).scalar() for f in (F.min, F.max))
    segments = history.groupBy("lead_behaviour_profile").agg(most_frequent("business_segment").alias("predicted_segment"))
    scored = predicted.withColumn(
        "score", F.when(high == low, 1.0).otherwise(1.0 - (F.col("days") - low) / F.nullif(high - low, F.lit(0.0)))
    ).join(segments, "lead_behaviour_profile", "left")
    return scored.select(
        "lead.*",
        half_even("days", 1).alias("predicted_days_to_close"),
        half_even("score", 4).alias("priority_score"),
        band("score", PRIORITY_BANDS).alias("priority_tier"),
        F.coalesce("predicted_segment", F.lit("unknown")).alias("predicted_segment"),
        band("days", LEAD_PACKAGE_BANDS).alias("onboarding_package"),
    )


def lead_profile_summary(scores: DataFrame) -> DataFrame:
    return scores.groupBy("lead_behaviour_profile").agg(
        F.count(KEY).alias("count"),
        half_even(F.avg("days_to_close"), 1).alias("avg_actual_days"),
        half_even(exact_mean("predicted_days_to_close"), 1).alias("avg_predicted_days"),
        half_even(exact_mean("priority_score"), 1).alias("avg_priority_score"),
        half_even(pct(F.col("priority_tier") == "HIGH"), 1).alias("pct_high_priority"),
    )


def lead_tier_distribution(scores: DataFrame) -> DataFrame:
    counts = scores.groupBy("priority_tier").agg(F.count("*").alias("lead_count"))
    return counts.withColumn("pct", half_even(share_of_total("lead_count") * 100, 1))


def lead_top(scores: DataFrame, n: int = 10) -> DataFrame:
    return scores.orderBy(F.desc("priority_score"), F.asc(KEY)).limit(n).select(
        KEY,
        "lead_behaviour_profile",
        "business_segment",
        "priority_score",
        "predicted_days_to_close",
        "priority_tier",
        "onboarding_package",
    )


def conversion_training(mql: DataFrame, acquisition: DataFrame, cfg: Config = Config()) -> DataFrame:
    """All leads with label and class weight; what an unconverted lead never told is ``unknown``."""
    leads = mql.select(KEY, blank_to_unknown("origin").alias("origin")).join(
        acquisition.select(KEY, *CATEGORIES, F.lit(1.0).alias("is_converted")), KEY, "left"
    )
    filled = leads.select(
        KEY, "origin", *[blank_to_unknown(c).alias(c) for c in CATEGORIES], F.coalesce("is_converted", F.lit(0.0)).alias("is_converted")
    )
    counts = filled.agg(F.sum("is_converted").alias("p"), F.count("*").alias("n"))
    weight = counts.select((F.col("n") - F.col("p")) / F.nullif("p", F.lit(0.0))).scalar()
    return filled.withColumn("weight", F.when(F.col("is_converted") == 1, weight).otherwise(1.0)).withColumn(
        "fold", hash_fold(KEY, cfg.folds, cfg.seed)
    )


def conversion_classifier(
    mql: DataFrame, acquisition: DataFrame, cut: Cut, cfg: Config = Config(), feature_sets: dict | None = None, at_once: int = 10
) -> DataFrame:
    """Cross-validated area under the precision-recall curve, next to the positive rate it must beat.

    Mean and deviation over all folds. Profile columns are only known for converted leads and give the label away;
    the ``origin`` set shows what remains without them.
    """
    feature_sets = feature_sets or {"all": ["origin", *CATEGORIES], "origin": ["origin"]}
    columns = sorted(set().union(*feature_sets.values()))
    training = cut(conversion_training(mql, acquisition, cfg), "conversion-leads")
    rows = cut(
        encode_out_of_fold(training, columns, "is_converted", "fold", cfg.encoding_smoothing), "conversion-training"
    )
    # every feature set and fold is a fit, and all grow in the same passes
    parts = [(used, fold) for used in feature_sets.values() for fold in range(cfg.folds)]
    fits = [Fit(tuple(columns.index(c) for c in used), fold) for used, fold in parts]
    encoded = [f"{c}_enc" for c in columns]
    fitted = boost(rows, encoded, "is_converted", KEY, fits, _boosting(cfg, logistic=True), cut, "fold", "weight")
    scored = cut(fitted.rows, "conversion-scored")
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="margin", metricName="areaUnderPR")

    def held_out(k: int) -> float:
        own = scored.where(F.col("fold") == fits[k].left_out)
        return float(evaluator.evaluate(own.select("label", F.col("predictions")[k].alias("margin"))))

    with ThreadPool(min(at_once, len(fits))) as pool:
        areas = pool.map(held_out, range(len(fits)))
    found = []
    for i, name in enumerate(feature_sets):
        own = areas[i * cfg.folds : (i + 1) * cfg.folds]
        found.append((name, fmean(own), pstdev(own)))
    scores = rows.sparkSession.createDataFrame(found, "feature_set string, auprc double, auprc_std double")
    rate = rows.agg(F.avg("is_converted")).scalar()
    weight = rows.agg(F.max("weight")).scalar()
    return scores.withColumn("base_rate", rate).withColumn("positive_weight", weight)
