"""Seller clustering into Starter, Growth and Premium."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.config import AD_CREDIT_SHARE, CLUSTER_AD_PACKAGES, SELLER_VALUE_MULTIPLIER, Config
from martloom.functions.aggregates import exact_mean
from martloom.functions.numbers import flag, half_even, lookup
from martloom.operators.clustering import Clusters, Start, kmeans, silhouettes
from martloom.operators.quantiles import exact_quantile
from martloom.operators.ranking import rank_rows, share_of_total
from martloom.session import cut

CLUSTER_FEATURES = ["log_revenue", "avg_review_score", "log_orders", "unique_categories"]
TIERS = ("Starter", "Growth", "Premium")

#: Sellers from which on k-means gets a further task.
PART = 1 << 13

Cut = Callable[[DataFrame, str], DataFrame]


def cluster_columns(performance: DataFrame) -> DataFrame:
    return performance.withColumns({"log_revenue": F.log1p("total_revenue"), "log_orders": F.log1p("total_orders")})


def fit_scaler(performance: DataFrame) -> PipelineModel:
    stages = [
        VectorAssembler(inputCols=CLUSTER_FEATURES, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
    ]
    return Pipeline(stages=stages).fit(cluster_columns(performance))


def scaled_sellers(performance: DataFrame, scaler: PipelineModel) -> DataFrame:
    return scaler.transform(cluster_columns(performance)).drop("raw_features")


def seller_cluster_features(performance: DataFrame) -> DataFrame:
    """Standardised features as plain columns, 6 decimals."""
    z = vector_to_array("features")
    return scaled_sellers(performance, fit_scaler(performance)).select(
        "seller_id", *[half_even(z[i], 6).alias(f"z_{name}") for i, name in enumerate(CLUSTER_FEATURES)]
    )


def _points(performance: DataFrame, scaler: PipelineModel) -> DataFrame:
    return scaled_sellers(performance, scaler).select("seller_id", vector_to_array("features").alias("features"))


def _spread(points: DataFrame) -> DataFrame:
    """The points in as many parts as cores can use: each iteration of k-means reads them all."""
    tasks = min(points.sparkSession.sparkContext.defaultParallelism, -(-points.count() // PART))
    return points.repartition(tasks, "seller_id") if tasks > 1 else points.coalesce(1)


def _best(found: list[Clusters]) -> Clusters:
    """The run with the least cost, the first of equals."""
    return min(found, key=lambda c: c.cost)


def cluster_validation(performance: DataFrame, cfg: Config = Config(), cut: Cut = cut) -> DataFrame:
    """Inertia and silhouette, on Euclidean distances, for each candidate k.

    Inertia is on features scaled by the population deviation. All starts of all candidates move in the same passes.
    """
    scaler = fit_scaler(performance)
    points = cut(_spread(_points(performance, scaler)), "seller-points")
    n = points.count()
    starts = [Start(k, cfg.seed + i) for k in cfg.cluster_range for i in range(cfg.cluster_range_starts)]
    found = kmeans(points, starts)
    best = [_best([c for c, s in zip(found, starts, strict=True) if s.k == k]) for k in cfg.cluster_range]
    scores = silhouettes(points, "seller_id", [c.nearest(F.col("features")) for c in best], cut)
    rows = [
        # one standard deviation is that of a sample, the other that of the population
        (k, round(c.cost * n / max(n - 1, 1), 2), round(s, 4)) for k, c, s in zip(cfg.cluster_range, best, scores, strict=True)
    ]
    top = max(rows, key=lambda r: r[2])[0]
    return performance.sparkSession.createDataFrame(
        [(*r, int(r[0] == top)) for r in rows], "k int, inertia double, silhouette_score double, is_best int"
    )


@dataclass
class SellerModel:
    scaler: PipelineModel
    clusters: Clusters

    def save(self, path: str) -> None:
        self.scaler.write().overwrite().save(f"{path}/scaler")
        rows = [(i, c.tolist(), self.clusters.cost) for i, c in enumerate(self.clusters.centers)]
        table = SparkSession.active().createDataFrame(rows, "cluster int, center array<double>, cost double")
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/clusters")

    @staticmethod
    def load(path: str) -> SellerModel:
        rows = SparkSession.active().read.parquet(f"{path}/clusters").orderBy("cluster").collect()  # one per cluster
        clusters = Clusters(np.array([r["center"] for r in rows]), rows[0]["cost"])
        return SellerModel(PipelineModel.load(f"{path}/scaler"), clusters)


def train_seller_model(performance: DataFrame, cfg: Config = Config(), cut: Cut = cut) -> SellerModel:
    scaler = fit_scaler(performance)
    points = cut(_spread(_points(performance, scaler)), "seller-points")
    return SellerModel(scaler, _best(kmeans(points, [Start(cfg.seller_clusters, cfg.seed + i) for i in range(cfg.cluster_starts)])))


def seller_tiers(performance: DataFrame, model: SellerModel, cfg: Config = Config()) -> DataFrame:
    """Cluster and revenue tier per seller, value flag, advertising package and credit."""
    scaled = scaled_sellers(performance, model.scaler)
    return tiers_of_clusters(scaled.withColumn("cluster", model.clusters.nearest(vector_to_array("features"))), cfg)


def tiers_of_clusters(clustered: DataFrame, cfg: Config = Config()) -> DataFrame:
    """The rules behind a ``cluster`` column: clusters become tiers by rising mean revenue.

    There are three tiers; with more clusters the top ones are all Premium, with fewer the upper tiers stay empty.
    """
    means = clustered.groupBy("cluster").agg(exact_mean("total_revenue").alias("_mean"))
    ranked = rank_rows(means, "_rank", [F.asc("_mean"), F.asc("cluster")])
    # one row per cluster
    names = ranked.select("cluster", lookup("_rank", dict(enumerate(TIERS, 1)), TIERS[-1]).alias("revenue_tier"))
    value = flag(F.col("avg_order_value") > cfg.hvc_spend_threshold)
    factor = F.when(value == 1, SELLER_VALUE_MULTIPLIER).otherwise(1.0)
    return clustered.join(F.broadcast(names), "cluster").select(
        "seller_id",
        "seller_state",
        "seller_city",
        "total_revenue",
        "avg_review_score",
        "total_orders",
        "unique_categories",
        "cluster",
        "revenue_tier",
        value.alias("hvc_aligned"),
        lookup("revenue_tier", CLUSTER_AD_PACKAGES).alias("ad_package"),
        half_even(F.col("avg_review_score") * 100 * F.col("total_orders") * factor * AD_CREDIT_SHARE, 2).alias("ad_credit_value"),
    )


def seller_tier_centroids(tiers: DataFrame) -> DataFrame:
    """Size, share and mean profile of each tier."""
    stats = tiers.groupBy("revenue_tier").agg(
        F.count("seller_id").alias("count"),
        half_even(exact_mean("total_revenue"), 1).alias("avg_revenue"),
        half_even(exact_mean("avg_review_score"), 1).alias("avg_review_score"),
        half_even(F.avg("total_orders"), 1).alias("avg_orders"),
        half_even(F.avg("unique_categories"), 1).alias("avg_categories"),
    )
    medians = exact_quantile(tiers, "total_revenue", 0.5, by=["revenue_tier"], name="median_revenue")
    return (
        stats.withColumn("pct_sellers", half_even(share_of_total("count") * 100, 1))
        .join(medians, "revenue_tier")
        .withColumn("median_revenue", half_even("median_revenue", 1))
    )


def seller_top(tiers: DataFrame, n: int = 10) -> DataFrame:
    return tiers.orderBy(F.desc("total_revenue"), F.asc("seller_id")).limit(n).select(
        "seller_id", "seller_state", "total_revenue", "avg_review_score", "revenue_tier", "hvc_aligned", "ad_credit_value"
    )
