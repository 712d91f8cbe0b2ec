"""Test tables in the shape of the raw inputs, and thresholds that fit their value ranges."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.config import Config

# Values near the quantiles of the test tables, so that every band and rule has rows.
CONFIG = Config(
    hvc_spend_threshold=2200.0,
    installments_above=10.0,
    national_avg_order_value=2120.0,
    push_plan_score=6.0,
    offer_upgrade_score=4.0,
    top_categories=("standard", "large", "medium"),
    frontier_states=("NATION_0", "NATION_1", "NATION_2", "NATION_3", "NATION_4"),
    default_state="NATION_0",
    customer_tiers=((100000, "Platinum"), (60000, "Gold"), (35000, "Silver"), (0, "Bronze")),
    seller_tiers=((32000, "Platinum"), (27000, "Gold"), (23000, "Silver"), (0, "Bronze")),
    seller_revenue_bands=((202000, "Starter"), (217000, "Growth"), (None, "Premium")),
    severity_tiers=((12, "CRITICAL"), (6, "HIGH"), (2, "MEDIUM"), (0, "LOW")),
)
# a seller's mean item price is far below a customer's mean order value
SELLER_CONFIG = replace(CONFIG, hvc_spend_threshold=535.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = {n: table(spark, sf_dir, n) for n in "customer nation orders lineitem part supplier events".split()}
    nation = t["nation"].select("n_nationkey", "n_name")
    part_type = F.col("p_type")
    event = F.col("event_id")
    return {
        "customers": t["customer"].join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("customer_id"),
            (F.col("c_custkey") - F.col("c_custkey") % 2).alias("customer_unique_id"),
            F.col("n_name").alias("customer_state"),
            F.col("c_mktsegment").alias("customer_city"),
        ),
        "orders": t["orders"].selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status",
            "o_orderdate AS order_purchase_timestamp",
            "CASE o_orderkey % 4 WHEN 0 THEN o_orderdate + INTERVAL '100' HOUR "
            "WHEN 1 THEN o_orderdate + INTERVAL '250' HOUR "
            "WHEN 2 THEN o_orderdate + INTERVAL '700' HOUR END AS order_delivered_customer_date",
            "o_orderdate + INTERVAL '480' HOUR AS order_estimated_delivery_date",
        ),
        "order_payments": t["lineitem"].select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            F.when(F.col("l_returnflag") == "A", "credit_card")
            .when(F.col("l_returnflag") == "N", "boleto")
            .when(F.col("l_linestatus") == "F", "voucher")
            .otherwise("debit_card")
            .alias("payment_type"),
            F.ceil(F.col("l_quantity") / 4).cast("int").alias("payment_installments"),
            (F.col("l_extendedprice") / 100).alias("payment_value"),
        ),
        "order_items": t["lineitem"].select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            (F.col("l_extendedprice") / 100).alias("price"),
            (F.col("l_extendedprice") * F.col("l_tax") / 100).alias("freight_value"),
        ),
        "products": t["part"].select(
            F.col("p_partkey").alias("product_id"),
            F.when(F.col("p_size") % 10 != 0, part_type).alias("product_category_name"),
        ),
        "category_translation": t["part"].where(part_type != "PROMO").select(
            part_type.alias("product_category_name"), F.lower(part_type).alias("product_category_name_english")
        ).distinct(),
        "sellers": t["supplier"].join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("seller_id"), F.col("n_name").alias("seller_state"), F.col("s_name").alias("seller_city")
        ),
        "order_reviews": t["events"].select(
            event.alias("review_id"),
            (event - event % 3).alias("order_id"),
            (F.floor("value").cast("int") % 5 + 1).alias("review_score"),
        ),
        "mql": t["events"].select(
            event.alias("mql_id"),
            F.to_date("ts").alias("first_contact_date"),
            F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("origin"),
        ),
        "closed_deals": t["events"].where(event % 11 == 0).selectExpr(
            "event_id AS mql_id",
            "event_id % 10 AS seller_id",
            "date_add(CAST(ts AS DATE), CAST(floor(value) AS INT)) AS won_date",
            "CASE event_id % 4 WHEN 0 THEN 'home_decor' WHEN 1 THEN 'health_beauty' WHEN 2 THEN 'pet' ELSE '' END AS business_segment",
            "CASE event_id % 2 WHEN 0 THEN 'online_medium' ELSE 'industry' END AS lead_type",
            "CASE event_id % 5 WHEN 0 THEN 'eagle' WHEN 1 THEN 'cat' WHEN 2 THEN 'wolf' WHEN 3 THEN 'shark' ELSE '' END AS lead_behaviour_profile",
            "CASE event_id % 3 WHEN 0 THEN 'reseller' ELSE 'manufacturer' END AS business_type",
            "CASE WHEN event_id % 7 = 0 THEN value * 100 ELSE 0.0D END AS declared_monthly_revenue",
        ),
    }


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw input that no mart reads."""
    return table(spark, sf_dir, "customer").selectExpr(
        "lpad(CAST(c_custkey % 100000 AS STRING), 5, '0') AS geolocation_zip_code_prefix",
        "c_acctbal / 100 AS geolocation_lat",
        "c_acctbal / 50 AS geolocation_lng",
        "c_mktsegment AS geolocation_city",
        "CAST(c_nationkey AS STRING) AS geolocation_state",
    )
