"""Model runs from marts to saved models and written results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from martloom.plans.analytics import SELLERS, in_order
from martloom.plans.ml import installments, leads, sellers
from martloom.plans.pipeline import ACQUISITION, PROFILE, Marts
from martloom.session import size_shuffles
from martloom.sources.marts import write_csv

Cut = Callable[[DataFrame, str], DataFrame]


def _write(folder: str, results: dict[str, tuple[DataFrame, list[str]]]) -> list[str]:
    for name, (df, order) in results.items():
        write_csv(in_order(df, order), f"{folder}/{name}")
    return list(results)


def run_lead_scoring(marts: Marts, folder: str, cut: Cut) -> list[str]:
    """Train and save the lead model, then write scores, importance, metrics and reports."""
    acquisition = marts.mart(ACQUISITION)
    size_shuffles(marts.spark, [acquisition])
    model = leads.train_lead_model(acquisition, cut, marts.cfg)
    model.save(f"{folder}/models/leads")
    # scored once, read by every report
    scores = cut(leads.lead_scores(acquisition, model, acquisition, cut), "lead-scores")
    return _write(
        folder,
        {
            "lead_scores": (scores, ["-priority_score"]),
            "lead_importance": (leads.feature_importance(model, marts.cfg), ["rank"]),
            "lead_attributions": (leads.feature_attributions(model), ["rank"]),
            "lead_metrics": (leads.lead_model_metrics(model), ["metric"]),
            "lead_profile_summary": (leads.lead_profile_summary(scores), ["avg_predicted_days"]),
            "lead_tier_distribution": (leads.lead_tier_distribution(scores), ["-lead_count"]),
        },
    )


def run_seller_tiers(marts: Marts, folder: str, cut: Cut) -> list[str]:
    """Check cluster counts, train and save the tier model, write tiers and their profiles."""
    performance = marts.mart(SELLERS)
    size_shuffles(marts.spark, [performance])
    model = sellers.train_seller_model(performance, marts.cfg)
    model.save(f"{folder}/models/sellers")
    tiers = cut(sellers.seller_tiers(performance, model, marts.cfg), "seller-tiers")
    return _write(
        folder,
        {
            "cluster_validation": (sellers.cluster_validation(performance, marts.cfg), ["k"]),
            "seller_tiers": (tiers, ["-total_revenue"]),
            "seller_tier_centroids": (sellers.seller_tier_centroids(tiers), ["avg_revenue"]),
        },
    )


def run_installments(marts: Marts, folder: str, cut: Cut) -> list[str]:
    """Train and save the installment model, write recommendations, coefficients and metrics."""
    profile = marts.mart(PROFILE)
    size_shuffles(marts.spark, [profile])
    model = installments.train_installment_model(profile, marts.cfg)
    model.write().overwrite().save(f"{folder}/models/installments")
    recommended = cut(installments.installment_recommendations(profile, model, marts.cfg), "installments")
    return _write(
        folder,
        {
            "installment_recommendations": (recommended, ["customer_unique_id"]),
            "installment_model_coefficients": (
                installments.installment_coefficients(model, profile.sparkSession),
                ["-abs_coef"],
            ),
            "installment_metrics": (installments.installment_model_metrics(profile, marts.cfg), ["metric"]),
            "installment_report": (installments.installment_report(profile, model), ["class"]),
            "installment_tier_distribution": (
                installments.installment_tier_distribution(recommended),
                ["-recommended_tier"],
            ),
        },
    )
