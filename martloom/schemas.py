"""Declared schemas of the raw inputs and the marts (DDL text)."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_DDL = {
    "orders": """order_id string, customer_id string, order_status string,
        order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,
        order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz,
        order_estimated_delivery_date timestamp_ntz""",
    "order_items": """order_id string, order_item_id int, product_id string, seller_id string,
        shipping_limit_date timestamp_ntz, price double, freight_value double""",
    "order_payments": """order_id string, payment_sequential int, payment_type string,
        payment_installments int, payment_value double""",
    "customers": """customer_id string, customer_unique_id string, customer_zip_code_prefix string,
        customer_city string, customer_state string""",
    # the source file misspells two names; they are corrected after the read
    "products": """product_id string, product_category_name string, product_name_lenght int,
        product_description_lenght bigint, product_photos_qty int, product_weight_g double,
        product_length_cm double, product_height_cm double, product_width_cm double""",
    "category_translation": "product_category_name string, product_category_name_english string",
    "sellers": "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
    "geolocation": """geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double,
        geolocation_city string, geolocation_state string""",
    "order_reviews": """review_id string, order_id string, review_score int, review_comment_title string,
        review_comment_message string, review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz""",
    "mql": "mql_id string, first_contact_date date, landing_page_id string, origin string",
    "closed_deals": """mql_id string, seller_id string, sdr_id string, sr_id string, won_date date,
        business_segment string, lead_type string, lead_behaviour_profile string, has_company string,
        has_gtin string, average_stock string, business_type string, declared_product_catalog_size double,
        declared_monthly_revenue double""",
}

# inputs whose texts may hold line breaks
MULTI_LINE = {"order_reviews"}

RAW_RENAMES = {
    "products": {
        "product_name_lenght": "product_name_length",
        "product_description_lenght": "product_description_length",
    }
}

# name -> (key columns, columns)
MART_DDL = {
    "mart_customer_payment_profile": (
        ["customer_unique_id"],
        """customer_unique_id string, customer_state string, customer_city string, total_orders bigint,
        total_spend double, avg_order_value double, is_high_value int, preferred_payment_type string,
        avg_installments double, credit_card_orders bigint, boleto_orders bigint, voucher_orders bigint,
        debit_card_orders bigint, max_installments_used int, uses_installments int, avg_review_score double,
        installment_bucket string""",
    ),
    "mart_order_payment_detail": (
        ["order_id"],
        """order_id string, customer_unique_id string, customer_state string, order_status string,
        order_purchase_timestamp timestamp_ntz, total_order_value double, total_payment_value double,
        payment_type string, payment_installments int, num_items int, product_categories string""",
    ),
    "mart_geo_payment_summary": (
        ["customer_state"],
        """customer_state string, total_customers bigint, high_value_customers bigint, total_revenue double,
        avg_order_value double, credit_card_pct double, boleto_pct double, installment_avg double,
        high_value_revenue_share double""",
    ),
    "mart_payment_leakage": (
        ["analysis_date", "state", "payment_type"],
        """analysis_date date, state string, payment_type string, order_count bigint, avg_value double,
        leakage_score double""",
    ),
    "mart_monthly_revenue": (
        ["year_month", "payment_type"],
        """year_month string, payment_type string, order_count bigint, total_revenue double,
        avg_order_value double""",
    ),
    "mart_hv_category_preference": (
        ["customer_unique_id", "product_category_en"],
        "customer_unique_id string, product_category_en string, order_count bigint, total_spend double",
    ),
    "mart_seller_acquisition": (
        ["mql_id"],
        """mql_id string, seller_id string, business_segment string, lead_type string,
        lead_behaviour_profile string, business_type string, first_contact_date date, won_date date,
        days_to_close int, declared_monthly_revenue double""",
    ),
    "mart_seller_performance": (
        ["seller_id"],
        """seller_id string, seller_state string, seller_city string, total_orders bigint,
        total_revenue double, avg_order_value double, avg_review_score double, unique_categories bigint,
        total_items_sold bigint""",
    ),
    "mart_repeat_customer": (
        ["customer_unique_id"],
        """customer_unique_id string, customer_state string, total_orders bigint, is_repeat_customer int,
        first_order_date date, last_order_date date, days_active int, is_high_value int""",
    ),
    "mart_product_price_range": (
        ["year_month", "product_category_en", "price_bucket"],
        """year_month string, product_category_en string, price_bucket string, order_count bigint,
        total_revenue double, avg_price double""",
    ),
    "mart_review_by_segment": (
        ["is_high_value", "payment_type", "customer_state"],
        """is_high_value int, payment_type string, customer_state string, avg_review_score double,
        total_reviews bigint, pct_5star double, pct_1star double, avg_delivery_days double,
        late_delivery_rate double""",
    ),
    "mart_mql_funnel": (
        ["origin"],
        """origin string, total_leads bigint, converted_leads bigint, conversion_rate double,
        avg_days_to_close double, top_business_segment string""",
    ),
    "mart_mql_monthly": (
        ["year_month", "origin"],
        """year_month string, origin string, total_leads bigint, converted_leads bigint,
        conversion_rate double""",
    ),
    "mart_lead_behaviour": (
        ["lead_behaviour_profile"],
        """lead_behaviour_profile string, total_deals bigint, avg_days_to_close double,
        avg_declared_revenue double, top_business_segment string""",
    ),
}


def raw_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(RAW_DDL[name])


def mart_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(MART_DDL[name][1])


def mart_keys(name: str) -> list[str]:
    return MART_DDL[name][0]
