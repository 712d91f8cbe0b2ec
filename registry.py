"""Registered queries: (session, folder of test tables) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import adapter
import oracles
from martloom.functions.aggregates import exact_sum
from martloom.functions.dates import year_month
from martloom.functions.numbers import half_even
from martloom.operators import sketches
from martloom.operators.keys import ensure_columns, latest_by_key
from martloom.operators.ranking import hash_fold, percentile_rank_all, rank_all, stratified_fold
from martloom.plans import monthly
from martloom.plans.analytics import ANALYTICS, SELLERS
from martloom.plans.insights import points
from martloom.plans.marts import sellers as seller_marts
from martloom.plans.ml import installments, leads, sellers
from martloom.plans.pipeline import ACQUISITION, DETAIL, PROFILE, STEPS, Marts
from martloom.schemas import RAW_DDL, raw_schema
from martloom.session import cut, scratch_dir, size_shuffles, tune
from martloom.sources import marts as mart_tables
from martloom.sources.quality import default_rules, load, not_negative, not_null
from martloom.sources.raw import normalize_strings, read_all_raw, read_raw, read_typed, rename_columns
from martloom.sources.refresh import read_months
from martloom.sources.versions import VersionedMart
from martloom.streaming import checkout

Query = Callable[[SparkSession, str], DataFrame]

_marts: dict[tuple[str, str], Marts] = {}


def marts(spark: SparkSession, sf_dir: str) -> Marts:
    """Marts over one folder; those another query already needed in this session are reused as tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _marts:
        tune(spark)
        raw = adapter.raw_tables(spark, sf_dir)
        size_shuffles(spark, raw.values())
        date = F.lit("2024-02-01").cast("date")
        _marts[key] = Marts(raw, cut, adapter.CONFIG, date, cut)
    return _marts[key]


def _mart(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts(spark, sf_dir).define(name)


def _analytics(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return ANALYTICS[name](marts(spark, sf_dir))


# ---------------------------------------------------------------- ingest
def ingest_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an untyped source would deliver them: missing origins, a boolean with gaps."""
    return normalize_strings(
        adapter.table(spark, sf_dir, "events").selectExpr(
            "event_id",
            "CASE WHEN event_type <> 'error' THEN event_type END AS origin",
            "CASE WHEN event_id % 3 <> 0 THEN value > 100 END AS has_company",
            "CASE WHEN event_id % 5 = 0 THEN double('NaN') ELSE value END AS declared_monthly_revenue",
        )
    )


def rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = adapter.table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id", "length(p_name) AS product_name_lenght", "p_size AS product_description_lenght"
    )
    return rename_columns(
        source,
        {"product_name_lenght": "product_name_length", "product_description_lenght": "product_description_length"},
    )


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality gate, which counts while the CSV files are loaded, before blanks are filled."""
    folder = _raw_csv_folder(spark, sf_dir)
    rules = default_rules() | {
        # rules that the test data breaks, so that counting violations is exercised too
        "products": [not_null("product_category_name")],
        "order_items": [not_null("order_id"), not_negative("price")],
    }
    _, report = load(spark, lambda session: {name: read_typed(session, folder, name) for name in rules}, rules)
    return report


def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapter.table(spark, sf_dir, "events")
    return latest_by_key(events, ["user_id"], [F.desc("ts"), F.desc("event_id")])


def evolved_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ensure_columns(
        adapter.table(spark, sf_dir, "customer"), {"avg_review_score": 0.0, "installment_bucket": "", "c_acctbal": -1.0}
    )


def _write_raw_csv(df: DataFrame, folder: str, name: str) -> None:
    """Write a table the way the sources deliver it, with all declared columns."""
    full = df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in raw_schema(name).fields
        ]
    )
    writer = full.write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
    writer.csv(f"{folder}/{name}.csv", header=True, quote='"', escape='"')


def _as_raw_csv(df: DataFrame, name: str) -> str:
    folder = f"{scratch_dir(df.sparkSession)}/raw-{uuid.uuid4().hex}"
    _write_raw_csv(df, folder, name)
    return folder


_csv_folders: dict[tuple[str, str], str] = {}


def _raw_csv_folder(spark: SparkSession, sf_dir: str) -> str:
    """All raw inputs as CSV files; written once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _csv_folders:
        folder = f"{scratch_dir(spark)}/raw-{uuid.uuid4().hex}"
        raw = marts(spark, sf_dir).raw | {"geolocation": adapter.geolocation(spark, sf_dir)}
        for name in RAW_DDL:
            _write_raw_csv(raw[name], folder, name)
        _csv_folders[key] = folder
    return _csv_folders[key]


#: An amount of each raw input.
RAW_AMOUNTS = {
    "order_items": "price + freight_value",
    "order_payments": "payment_value",
    "geolocation": "geolocation_lat",
    "order_reviews": "CAST(review_score AS DOUBLE)",
    "closed_deals": "declared_monthly_revenue",
}


def raw_csv_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw inputs through their CSV files: rows, keys that are not blank, and the total of an amount."""
    read = read_all_raw(spark, _raw_csv_folder(spark, sf_dir))
    reports = []
    for name, df in read.items():
        amount = F.expr(RAW_AMOUNTS[name]) if name in RAW_AMOUNTS else F.lit(None).cast("double")
        reports.append(
            df.agg(
                F.count("*").alias("row_count"),
                F.count_if(F.col(df.columns[0]) != "").alias("keys"),
                half_even(exact_sum(amount), 6).alias("amount"),
            ).select(F.lit(name).alias("input"), "row_count", "keys", "amount")
        )
    return reduce(DataFrame.unionByName, reports)


def raw_csv_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV scan: zip codes keep their leading zeros."""
    source = marts(spark, sf_dir).raw["customers"].select(
        "customer_id",
        "customer_unique_id",
        F.lpad((F.col("customer_id") % 100000).cast("string"), 5, "0").alias("customer_zip_code_prefix"),
        "customer_city",
        "customer_state",
    )
    return read_raw(spark, _as_raw_csv(source, "customers"), "customers")


def raw_csv_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV scan: timestamps, some of them missing."""
    source = marts(spark, sf_dir).raw["orders"].select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        F.lit(None).cast("timestamp_ntz").alias("order_approved_at"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_carrier_date"),
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    return read_raw(spark, _as_raw_csv(source, "orders"), "orders")


def mart_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart as CSV sink and CSV source."""
    path = f"{scratch_dir(spark)}/csv-{uuid.uuid4().hex}"
    mart_tables.write_csv(marts(spark, sf_dir).mart("mart_monthly_revenue"), path)
    return mart_tables.read_mart_csv(spark, "mart_monthly_revenue", path)


def mart_csv_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All marts through their CSV form: rows, and the total of a column, after they are read back."""
    folder, reports = f"{scratch_dir(spark)}/csv-{uuid.uuid4().hex}", []
    for name, amount in oracles.MART_AMOUNTS.items():
        mart_tables.write_csv(marts(spark, sf_dir).mart(name), f"{folder}/{name}")
        back = mart_tables.read_mart_csv(spark, name, f"{folder}/{name}")
        total = half_even(exact_sum(F.col(amount).cast("double")), 6)
        reports.append(back.agg(F.count("*").alias("row_count"), total.alias("total")).select(F.lit(name).alias("mart"), "*"))
    return reduce(DataFrame.unionByName, reports)


def export_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All marts through the export, and the row counts that arrived."""
    folder = f"{scratch_dir(spark)}/export-{uuid.uuid4().hex}"
    names = [name for step in STEPS for name in step]
    mart_tables.export_marts([(n, marts(spark, sf_dir).mart(n)) for n in names], mart_tables.parquet_writer(folder))
    counted = [
        spark.read.parquet(f"{folder}/{n}").agg(F.count("*").alias("row_count")).select(F.lit(n).alias("mart"), "row_count")
        for n in names
    ]
    return reduce(DataFrame.unionByName, counted)


def mart_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart refreshed in full, then a newer version of some customers: the newer rows count."""
    folder, name = f"{scratch_dir(spark)}/versions-{uuid.uuid4().hex}", "mart_repeat_customer"
    repeat = marts(spark, sf_dir).mart(name)
    mart_tables.write_mart(repeat, name, folder)
    newer = repeat.where("total_orders > 6").withColumn("days_active", F.lit(-1))
    mart_tables.append_version(newer, name, folder, F.current_timestamp() + F.expr("INTERVAL 1 DAY"))
    return mart_tables.read_latest(spark, name, folder).drop("updated_at")


def order_value_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles per state, merged from monthly sketches, and whether their true ranks are within the stated error.

    Twice the error that a sketch exceeds in 1 % of cases, as some hundred quartiles are looked at.
    """
    detail = marts(spark, sf_dir).mart(DETAIL).select(
        "customer_state", year_month("order_purchase_timestamp").alias("year_month"), "total_order_value"
    )
    months = cut(sketches.quantile_sketches(detail, "total_order_value", ["year_month", "customer_state"]), "order-value-sketches")
    quarters = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    found = sketches.merge_quantiles(months, quarters, ["customer_state"])
    value, error = F.col("total_order_value"), 2 * sketches.rank_error()
    joined = detail.join(found, "customer_state")
    ranks = [F.count_if(value < F.col(q)).alias(f"{q}_below") for q in quarters] + [F.count_if(value <= F.col(q)).alias(f"{q}_upto") for q in quarters]
    checked = joined.groupBy("customer_state", "n").agg(*ranks)
    near = [
        ((F.col(f"{name}_below") <= (q + error) * F.col("n")) & (F.col(f"{name}_upto") >= (q - error) * F.col("n"))).cast("int").alias(f"{name}_within")
        for name, q in quarters.items()
    ]
    return checked.select("customer_state", "n", *near)


def seller_breadth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct orders and categories per seller, from sketches that were written per month."""
    m = marts(spark, sf_dir)
    sold = seller_marts.sold_items(m.raw["order_items"].where("seller_id IS NOT NULL"), m.raw["orders"], m.part("reviews_by_order"), m.part("product_categories"))
    return seller_marts.seller_breadth(cut(seller_marts.seller_month_sketches(sold), "seller-sketches"))


def seller_performance_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seller mart with distinct counts by sketches, exact at this size."""
    m = marts(spark, sf_dir)
    return seller_marts.seller_performance(
        m.raw["order_items"], m.raw["orders"], m.raw["sellers"], m.part("reviews_by_order"), m.part("product_categories"), sketch=sketches.LOG_VALUES
    )


def customer_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's rank by orders and average percentile rank, found in ranges."""
    profile = marts(spark, sf_dir).mart(PROFILE).select("customer_unique_id", "total_orders")
    ranked = rank_all(profile, "order_rank", [F.desc("total_orders"), F.asc("customer_unique_id")], cut)
    return percentile_rank_all(ranked, "total_orders", "order_percentile", cut)


def _grown_files(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, DataFrame]]:
    """Monthly marts built from raw files, then refreshed after more files came; the marts' folder."""
    base = f"{scratch_dir(spark)}/monthly-{uuid.uuid4().hex}"
    raw = marts(spark, sf_dir).raw
    late = {
        "orders": F.col("order_id") % 50 == 0,
        "order_payments": F.col("order_id") % 50 == 0,
        "order_items": F.col("order_id") % 50 == 0,
        "mql": F.col("mql_id") % 50 == 0,
        "closed_deals": F.col("mql_id") % 50 == 0,
    }
    for name, later in late.items():
        raw[name].where(~later).write.parquet(f"{base}/raw/{name}")

    def read() -> dict[str, DataFrame]:
        files = {name: spark.read.schema(raw[name].schema).parquet(f"{base}/raw/{name}") for name in late}
        return files | {name: raw[name] for name in ("customers", "products", "category_translation")}

    _, moment = monthly.refresh(read(), f"{base}/marts", None)
    for name, later in late.items():
        raw[name].where(later).write.mode("append").parquet(f"{base}/raw/{name}")
    monthly.refresh(read(), f"{base}/marts", moment)
    return f"{base}/marts", read()


def monthly_refresh(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A monthly mart after a refresh of the months that late files touched."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _refreshed:
        _refreshed[key] = _grown_files(spark, sf_dir)[0]
    return read_months(spark, name, _refreshed[key])


_refreshed: dict[tuple[str, str], str] = {}


def mart_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions of :func:`mart_versions` in buckets, compacted into one base."""
    repeat = marts(spark, sf_dir).mart("mart_repeat_customer")
    kept = VersionedMart(spark, "mart_repeat_customer", f"{scratch_dir(spark)}/buckets-{uuid.uuid4().hex}", "customer_unique_id", 8)
    kept.refresh(repeat, F.current_timestamp())
    for days in (-2, -1):
        newer = repeat.where("total_orders > 6").withColumn("days_active", F.lit(days))
        kept.append(newer, F.current_timestamp() + F.expr("INTERVAL 1 DAY"))
    kept.compact()
    return kept.read().drop("updated_at")


def cross_validation_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stratified and plain folds of the customers."""
    profile = marts(spark, sf_dir).mart(PROFILE).select("customer_unique_id", "uses_installments")
    folds = stratified_fold(profile, "customer_unique_id", "uses_installments", 5, 42, "stratified_fold")
    return folds.withColumn("plain_fold", hash_fold("customer_unique_id", 5, 42))


# ---------------------------------------------------------------- variants for the test data
def seller_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points.seller_points(marts(spark, sf_dir).mart("mart_seller_performance"), adapter.SELLER_CONFIG)


def tier_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = ANALYTICS["customer_points"](marts(spark, sf_dir))
    return points.tier_summary(customers, seller_points(spark, sf_dir), adapter.CONFIG)



def category_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the list as text, as in the CSV output
    return ANALYTICS["category_timing"](marts(spark, sf_dir)).withColumn(
        "peak_month_nums", F.concat(F.lit("["), F.array_join(F.col("peak_month_nums").cast("array<string>"), ", "), F.lit("]"))
    )


# ---------------------------------------------------------------- models
_models: dict[tuple, object] = {}


def _model(kind: str, spark: SparkSession, sf_dir: str, train, load):
    """Train once per session and folder, save, and go on from the saved copy."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _models:
        path = f"{scratch_dir(spark)}/{kind}-{uuid.uuid4().hex}"
        fitted = train()
        if hasattr(fitted, "save") and not hasattr(fitted, "stages"):
            fitted.save(path)
        else:
            fitted.write().overwrite().save(path)
        _models[key] = load(path)
    return _models[key]


def lead_model(spark: SparkSession, sf_dir: str) -> leads.LeadModel:
    acquisition = marts(spark, sf_dir).mart(ACQUISITION)
    return _model(
        "lead-model",
        spark,
        sf_dir,
        lambda: leads.train_lead_model(acquisition, cut, adapter.CONFIG),
        lambda path: leads.LeadModel.load(spark, path),
    )


def seller_model(spark: SparkSession, sf_dir: str) -> sellers.SellerModel:
    performance = marts(spark, sf_dir).mart(SELLERS)
    return _model(
        "seller-model",
        spark,
        sf_dir,
        lambda: sellers.train_seller_model(performance, adapter.SELLER_CONFIG),
        sellers.SellerModel.load,
    )


def installment_model(spark: SparkSession, sf_dir: str) -> PipelineModel:
    profile = marts(spark, sf_dir).mart(PROFILE)
    return _model(
        "installment-model",
        spark,
        sf_dir,
        lambda: installments.train_installment_model(profile, adapter.CONFIG),
        PipelineModel.load,
    )


def _rounded(df: DataFrame, columns: list[str], places: int = 9) -> DataFrame:
    """Logarithms and encodings end in different last bits in different engines."""
    return df.withColumns({c: half_even(c, places) for c in columns})


def lead_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(leads.lead_features(marts(spark, sf_dir).mart(ACQUISITION)), ["log_revenue"])


def target_encode_oof(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = leads.encoded_leads(marts(spark, sf_dir).mart(ACQUISITION), adapter.CONFIG)
    columns = [f"{c}_enc" for c in leads.CATEGORIES]
    return _rounded(encoded.select("mql_id", "fold", "days_to_close", *columns), columns)


def target_encode_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(leads.lead_encodings(marts(spark, sf_dir).mart(ACQUISITION), adapter.CONFIG), ["encoded"])


def lead_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    acquisition = marts(spark, sf_dir).mart(ACQUISITION)
    return leads.lead_scores(acquisition, lead_model(spark, sf_dir), acquisition, cut)


def lead_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.lead_model_metrics(lead_model(spark, sf_dir))


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.feature_importance(lead_model(spark, sf_dir), adapter.CONFIG)


def lead_conversion_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = marts(spark, sf_dir)
    return leads.conversion_classifier(m.raw["mql"], m.mart(ACQUISITION), cut, adapter.CONFIG)


def seller_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    performance = marts(spark, sf_dir).mart(SELLERS)
    return sellers.seller_tiers(performance, seller_model(spark, sf_dir), adapter.SELLER_CONFIG)


def installment_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = installments.installment_features(marts(spark, sf_dir).mart(PROFILE), adapter.CONFIG)
    return _rounded(features, ["log_avg_order_value", "log_total_orders"])


def installment_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return installments.installment_coefficients(installment_model(spark, sf_dir), spark)


def installment_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = marts(spark, sf_dir).mart(PROFILE)
    return installments.installment_recommendations(profile, installment_model(spark, sf_dir), adapter.CONFIG)


def installment_final_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return installment_recommendations(spark, sf_dir).groupBy("recommended_tier", "final_recommend").agg(
        F.count("*").alias("customer_count")
    )


def checkout_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per order, as the checkout would send it; a customer without a profile is a new one."""
    m = marts(spark, sf_dir)
    detail, profile = m.detail_and_profile()
    return checkout.checkout_events(detail, profile.select("customer_unique_id", "total_orders", "is_high_value"))


def checkout_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events arrive as files, are scored as a stream, and the sink is read back."""
    base = f"{scratch_dir(spark)}/checkout-{uuid.uuid4().hex}"
    events = checkout_events(spark, sf_dir)
    events.write.parquet(f"{base}/in")
    stream = checkout.read_checkouts(spark, f"{base}/in", events.schema)
    query = checkout.start_scoring(
        stream, installment_model(spark, sf_dir), f"{base}/out", f"{base}/state", adapter.CONFIG
    )
    query.awaitTermination()
    return spark.read.parquet(f"{base}/out")


# ---------------------------------------------------------------- the rules behind the models, on a score from the tables
def _score(column: str) -> Column:
    """A number from 0 to 1 that depends on the key alone."""
    return F.expr(f"pmod({column} * 7919, 1009) / 1009D")


def lead_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    acquisition = marts(spark, sf_dir).mart(ACQUISITION)
    predicted = acquisition.select(
        F.struct(*acquisition.columns).alias("lead"), "lead_behaviour_profile", (_score("mql_id") * 120).alias("days")
    )
    return leads.priorities(predicted, acquisition)


def seller_cluster_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered = marts(spark, sf_dir).mart(SELLERS).withColumn("cluster", F.expr("CAST(seller_id % 3 AS INT)"))
    return sellers.tiers_of_clusters(clustered, adapter.SELLER_CONFIG)


def installment_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return installments.recommend(marts(spark, sf_dir).mart(PROFILE), _score("customer_unique_id"), adapter.CONFIG)


def _decided(events: DataFrame) -> DataFrame:
    return installments.decide(events.withColumn("_p", _score("order_id")), events.columns, adapter.CONFIG)


def checkout_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decided(checkout_events(spark, sf_dir))


def checkout_decision_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same decisions on a stream of event files, read back from the sink."""
    base = f"{scratch_dir(spark)}/decisions-{uuid.uuid4().hex}"
    events = checkout_events(spark, sf_dir)
    events.write.parquet(f"{base}/in")
    stream = checkout.read_checkouts(spark, f"{base}/in", events.schema)
    checkout.start_sink(_decided(stream), f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/out")


def checkout_numbers_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer as a stream counts them, from files in no order of time, some of which come twice."""
    base = f"{scratch_dir(spark)}/numbers-{uuid.uuid4().hex}"
    events = marts(spark, sf_dir).mart(DETAIL).select(
        "order_id", "customer_unique_id", F.col("order_purchase_timestamp").cast("timestamp").alias("at")
    )
    for part in (0, 1, 2, 1):
        events.where(F.pmod(F.xxhash64("order_id"), F.lit(3)) == part).write.mode("append").parquet(f"{base}/in")
    stream = checkout.read_checkouts(spark, f"{base}/in", events.schema, files_per_batch=8)
    # longer than the orders go back, so that none is late
    groups = max(64, marts(spark, sf_dir).raw["customers"].count() // 64)
    numbered = checkout.numbered_checkouts(stream, "at", lateness="20000 days", groups=groups)
    checkout.start_sink(numbered, f"{base}/out", f"{base}/state").awaitTermination()
    counted = spark.read.parquet(f"{base}/out").groupBy("customer_unique_id")
    return counted.agg(F.count("*").alias("orders"), F.max("order_number").alias("last_number"), F.count_distinct("order_number").alias("numbers"))


QUERIES: dict[str, Query] = {
    "ingest_normalize": ingest_normalize,
    "rename_columns": rename,
    "dq_report": quality,
    "latest_by_key": latest_event,
    "ensure_columns": evolved_profile,
    "raw_csv_customers": raw_csv_customers,
    "raw_csv_orders": raw_csv_orders,
    "raw_csv_all": raw_csv_all,
    "lead_priorities": lead_priorities,
    "lead_priority_profiles": lambda spark, sf: leads.lead_profile_summary(lead_priorities(spark, sf)),
    "lead_priority_tiers": lambda spark, sf: leads.lead_tier_distribution(lead_priorities(spark, sf)),
    "lead_priority_top10": lambda spark, sf: leads.lead_top(lead_priorities(spark, sf)),
    "seller_cluster_tiers": seller_cluster_tiers,
    "seller_cluster_centroids": lambda spark, sf: sellers.seller_tier_centroids(seller_cluster_tiers(spark, sf)),
    "seller_cluster_top10": lambda spark, sf: sellers.seller_top(seller_cluster_tiers(spark, sf)),
    "installment_decisions": installment_decisions,
    "installment_decision_tiers": lambda spark, sf: installments.installment_tier_distribution(
        installment_decisions(spark, sf)
    ),
    "installment_decision_counts": lambda spark, sf: installment_decisions(spark, sf)
    .groupBy("recommended_tier", "final_recommend")
    .agg(F.count("*").alias("customer_count")),
    "checkout_decisions": checkout_decisions,
    "checkout_decision_stream": checkout_decision_stream,
    "checkout_numbers_stream": checkout_numbers_stream,
}
QUERIES |= {name: partial(_mart, name) for step in STEPS for name in step}
QUERIES |= {name: partial(_analytics, name) for name in ANALYTICS}
QUERIES |= {"seller_points": seller_points, "tier_summary": tier_summary, "category_timing": category_timing}
QUERIES |= {
    "mart_csv_round_trip": mart_csv_round_trip,
    "mart_csv_all": mart_csv_all,
    "export_marts": export_marts,
    "mart_versions": mart_versions,
    "cross_validation_folds": cross_validation_folds,
    "mart_compaction": mart_compaction,
    "order_value_quantiles": order_value_quantiles,
    "seller_breadth": seller_breadth,
    "seller_performance_sketched": seller_performance_sketched,
    "customer_ranks": customer_ranks,
    "refreshed_monthly_revenue": partial(monthly_refresh, monthly.REVENUE),
    "refreshed_price_range": partial(monthly_refresh, monthly.PRICES),
    "refreshed_mql_monthly": partial(monthly_refresh, monthly.LEADS),
    "lead_features": lead_features,
    "target_encode_oof": target_encode_oof,
    "target_encode_mapping": target_encode_mapping,
    "lead_regressor": lead_regressor,
    "lead_scores": lead_scores,
    "lead_profile_summary": lambda spark, sf: leads.lead_profile_summary(lead_scores(spark, sf)),
    "lead_tier_distribution": lambda spark, sf: leads.lead_tier_distribution(lead_scores(spark, sf)),
    "lead_top10": lambda spark, sf: leads.lead_top(lead_scores(spark, sf)),
    "feature_importance": feature_importance,
    "feature_attributions": lambda spark, sf: leads.feature_attributions(lead_model(spark, sf)),
    "lead_conversion_classifier": lead_conversion_classifier,
    "seller_cluster_features": lambda spark, sf: sellers.seller_cluster_features(marts(spark, sf).mart(SELLERS)),
    "cluster_validation": lambda spark, sf: sellers.cluster_validation(marts(spark, sf).mart(SELLERS), adapter.CONFIG),
    "seller_tiers": seller_tiers,
    "seller_tier_centroids": lambda spark, sf: sellers.seller_tier_centroids(seller_tiers(spark, sf)),
    "seller_top10": lambda spark, sf: sellers.seller_top(seller_tiers(spark, sf)),
    "installment_features": installment_features,
    "installment_model": lambda spark, sf: installments.installment_model_metrics(
        marts(spark, sf).mart(PROFILE), adapter.CONFIG
    ),
    "installment_report": lambda spark, sf: installments.installment_report(
        marts(spark, sf).mart(PROFILE), installment_model(spark, sf)
    ),
    "installment_coefficients": installment_coefficients,
    "installment_recommendations": installment_recommendations,
    "installment_tier_distribution": lambda spark, sf: installments.installment_tier_distribution(
        installment_recommendations(spark, sf)
    ),
    "installment_final_decision": installment_final_decision,
    "checkout_stream": checkout_stream,
}


def _comparable(name: str, query: Query) -> Query:
    """Totals and means at six decimals, as their SQL has them."""
    columns = oracles.ROUNDED.get(name)
    return (lambda spark, sf_dir: _rounded(query(spark, sf_dir), columns, 6)) if columns else query


QUERIES = {name: _comparable(name, query) for name, query in QUERIES.items()}
