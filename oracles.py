"""Independent SQL for every query that SQL can express, runnable on the test tables."""

from __future__ import annotations

# Named pieces: (SQL, names it reads). A query's text is its pieces as CTEs, in order.
PIECES: dict[str, tuple[str, str]] = {}


def piece(name: str, needs: str, sql: str) -> None:
    PIECES[name] = (sql.strip(), needs)


def with_pieces(needs: str, sql: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for need in PIECES[name][1].split():
            visit(need)
        order.append(name)

    for name in needs.split():
        visit(name)
    ctes = ",\n".join(f"{n} AS MATERIALIZED (\n{PIECES[n][0]}\n)" for n in order)
    return f"WITH {ctes}\n{sql.strip()}" if ctes else sql.strip()


def money(x: str, where: str = "") -> str:
    """Total of the numbers as they are written, to 12 places, so that no order of summation changes it."""
    return f"CAST(sum(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38, 12))){where} AS DOUBLE)"


def mean(x: str) -> str:
    return f"({money(x)} / count({x}))"


def rounded(sql: str, columns: list[str]) -> str:
    """The query with these columns at six decimals, as the registered query gives them."""
    return f"SELECT * REPLACE ({', '.join(f'round_even({c}, 6) AS {c}' for c in columns)}) FROM (\n{sql}\n)"


# ---------------------------------------------------------------- raw-shaped inputs
piece("customers", "", """
SELECT c_custkey AS customer_id, c_custkey - c_custkey % 2 AS customer_unique_id,
       n_name AS customer_state, c_mktsegment AS customer_city
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
piece("v_orders", "", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
       o_orderdate AS order_purchase_timestamp,
       CASE o_orderkey % 4 WHEN 0 THEN o_orderdate + INTERVAL '100' HOUR
                           WHEN 1 THEN o_orderdate + INTERVAL '250' HOUR
                           WHEN 2 THEN o_orderdate + INTERVAL '700' HOUR END AS order_delivered_customer_date,
       o_orderdate + INTERVAL '480' HOUR AS order_estimated_delivery_date
FROM orders""")
piece("order_payments", "", """
SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
       CASE WHEN l_returnflag = 'A' THEN 'credit_card' WHEN l_returnflag = 'N' THEN 'boleto'
            WHEN l_linestatus = 'F' THEN 'voucher' ELSE 'debit_card' END AS payment_type,
       CAST(ceil(l_quantity / 4) AS INT) AS payment_installments,
       l_extendedprice / 100 AS payment_value
FROM lineitem""")
piece("order_items", "", """
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
       l_extendedprice / 100 AS price, l_extendedprice * l_tax / 100 AS freight_value
FROM lineitem""")
piece("products", "", """
SELECT p_partkey AS product_id, CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_type END AS product_category_name
FROM part""")
piece("translation", "", """
SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
FROM part WHERE p_type <> 'PROMO'""")
piece("sellers", "", """
SELECT s_suppkey AS seller_id, n_name AS seller_state, s_name AS seller_city
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
piece("order_reviews", "", """
SELECT event_id AS review_id, event_id - event_id % 3 AS order_id, 1 + CAST(floor(value) AS INT) % 5 AS review_score
FROM events""")
piece("mql", "", """
SELECT event_id AS mql_id, CAST(ts AS DATE) AS first_contact_date,
       CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS origin
FROM events""")
piece("closed_deals", "", """
SELECT event_id AS mql_id, event_id % 10 AS seller_id, CAST(ts AS DATE) + CAST(floor(value) AS INT) AS won_date,
       CASE event_id % 4 WHEN 0 THEN 'home_decor' WHEN 1 THEN 'health_beauty' WHEN 2 THEN 'pet' ELSE '' END AS business_segment,
       CASE event_id % 2 WHEN 0 THEN 'online_medium' ELSE 'industry' END AS lead_type,
       CASE event_id % 5 WHEN 0 THEN 'eagle' WHEN 1 THEN 'cat' WHEN 2 THEN 'wolf' WHEN 3 THEN 'shark' ELSE '' END AS lead_behaviour_profile,
       CASE event_id % 3 WHEN 0 THEN 'reseller' ELSE 'manufacturer' END AS business_type,
       CASE WHEN event_id % 7 = 0 THEN value * 100 ELSE 0.0 END AS declared_monthly_revenue
FROM events WHERE event_id % 11 = 0""")
piece("category", "products translation", """
SELECT product_id, coalesce(nullif(product_category_name_english, ''), nullif(p.product_category_name, ''), 'unknown') AS category_en
FROM products p LEFT JOIN translation t ON p.product_category_name = t.product_category_name""")
piece("completed", "v_orders", "SELECT * FROM v_orders WHERE order_status IN ('delivered', 'shipped', 'approved')")
piece("order_mode", "order_payments", """
SELECT order_id, payment_type FROM (
  SELECT order_id, payment_type, row_number() OVER (PARTITION BY order_id ORDER BY count(*) DESC, payment_type) AS rn
  FROM order_payments GROUP BY order_id, payment_type)
WHERE rn = 1""")
piece("pay_agg", "order_payments order_mode", f"""
SELECT p.order_id, {money('payment_value')} AS paid, max(payment_installments) AS max_installments, any_value(m.payment_type) AS payment_type,
       max(CAST(p.payment_type = 'credit_card' AS INT)) AS is_cc, max(CAST(p.payment_type = 'boleto' AS INT)) AS is_bo,
       max(CAST(p.payment_type = 'voucher' AS INT)) AS is_vo, max(CAST(p.payment_type = 'debit_card' AS INT)) AS is_db
FROM order_payments p JOIN order_mode m ON m.order_id = p.order_id GROUP BY p.order_id""")

# ---------------------------------------------------------------- marts
piece("customer_base", "completed pay_agg customers v_orders order_reviews", f"""
WITH s AS (SELECT o.order_id, c.customer_unique_id, c.customer_state, c.customer_city, p.*  EXCLUDE (order_id)
           FROM completed o LEFT JOIN customers c ON o.customer_id = c.customer_id LEFT JOIN pay_agg p ON o.order_id = p.order_id),
     pref AS (SELECT customer_unique_id, payment_type FROM (
                SELECT customer_unique_id, payment_type, row_number() OVER (PARTITION BY customer_unique_id ORDER BY count(*) DESC, payment_type) AS rn
                FROM s WHERE payment_type IS NOT NULL GROUP BY customer_unique_id, payment_type) WHERE rn = 1),
     rid AS (SELECT o.customer_id, avg(r.review_score) AS score FROM v_orders o JOIN order_reviews r ON o.order_id = r.order_id GROUP BY o.customer_id),
     rev AS (SELECT customer_unique_id, {mean('score')} AS score FROM rid JOIN customers USING (customer_id) GROUP BY customer_unique_id),
     agg AS (SELECT customer_unique_id, arg_min(customer_state, order_id) AS customer_state, arg_min(customer_city, order_id) AS customer_city,
                    count(order_id) AS total_orders, coalesce({money('paid')}, 0) AS total_spend,
                    {money('paid')} / nullif(count(paid), 0) AS avg_order_value,
                    coalesce(avg(max_installments), 0) AS avg_installments, coalesce(max(max_installments), 0) AS max_installments_used,
                    CAST(coalesce(sum(is_cc), 0) AS BIGINT) AS credit_card_orders, CAST(coalesce(sum(is_bo), 0) AS BIGINT) AS boleto_orders,
                    CAST(coalesce(sum(is_vo), 0) AS BIGINT) AS voucher_orders, CAST(coalesce(sum(is_db), 0) AS BIGINT) AS debit_card_orders
             FROM s WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id)
SELECT agg.*, coalesce(pref.payment_type, 'unknown') AS preferred_payment_type, coalesce(rev.score, 0) AS avg_review_score
FROM agg LEFT JOIN pref USING (customer_unique_id) LEFT JOIN rev USING (customer_unique_id)""")
piece("profile", "customer_base", """
SELECT customer_unique_id, customer_state, customer_city, total_orders, total_spend, avg_order_value,
       CAST(total_spend >= (SELECT quantile_cont(total_spend, 0.75) FROM customer_base) AS INT) AS is_high_value,
       preferred_payment_type, avg_installments, credit_card_orders, boleto_orders, voucher_orders, debit_card_orders,
       max_installments_used, CAST(avg_installments > 10 AS INT) AS uses_installments, avg_review_score,
       CASE WHEN max_installments_used <= 1 THEN '1' WHEN max_installments_used <= 6 THEN '2-6'
            WHEN max_installments_used <= 12 THEN '7-12' ELSE '12+' END AS installment_bucket
FROM customer_base""")
piece("detail", "v_orders customers pay_agg order_items", f"""
WITH it AS (SELECT order_id, count(*) AS num_items, {money('price + freight_value')} AS value FROM order_items GROUP BY order_id)
SELECT o.order_id, c.customer_unique_id, coalesce(c.customer_state, '') AS customer_state, o.order_status, o.order_purchase_timestamp,
       coalesce(it.value, 0) AS total_order_value, coalesce(p.paid, 0) AS total_payment_value,
       coalesce(p.payment_type, 'unknown') AS payment_type, coalesce(p.max_installments, 0) AS payment_installments,
       CAST(coalesce(it.num_items, 0) AS INT) AS num_items, '' AS product_categories
FROM v_orders o LEFT JOIN customers c ON o.customer_id = c.customer_id
LEFT JOIN pay_agg p ON o.order_id = p.order_id LEFT JOIN it ON o.order_id = it.order_id""")
piece("geo", "profile", f"""
SELECT customer_state, count(*) AS total_customers, count(*) FILTER (is_high_value = 1) AS high_value_customers,
       {money('total_spend')} AS total_revenue, {mean('avg_order_value')} AS avg_order_value,
       avg(CAST(preferred_payment_type = 'credit_card' AS INT)) AS credit_card_pct,
       avg(CAST(preferred_payment_type = 'boleto' AS INT)) AS boleto_pct, {mean('avg_installments')} AS installment_avg,
       coalesce({money('total_spend', ' FILTER (is_high_value = 1)')}, 0) / {money('total_spend')} AS high_value_revenue_share
FROM profile GROUP BY customer_state""")
piece("monthly", "detail", f"""
SELECT strftime(order_purchase_timestamp, '%Y-%m') AS year_month, payment_type, count(total_payment_value) AS order_count,
       {money('total_payment_value')} AS total_revenue, {money('total_payment_value')} / count(total_payment_value) AS avg_order_value
FROM detail WHERE order_status IN ('delivered', 'shipped', 'approved') AND payment_type <> '' GROUP BY 1, 2""")
piece("hv_category", "detail profile order_items category", f"""
SELECT o.customer_unique_id, coalesce(c.category_en, 'unknown') AS product_category_en, count(o.order_id) AS order_count,
       coalesce({money('i.price')}, 0) AS total_spend
FROM detail o JOIN profile p ON o.customer_unique_id = p.customer_unique_id
LEFT JOIN order_items i ON o.order_id = i.order_id LEFT JOIN category c ON i.product_id = c.product_id
WHERE p.is_high_value = 1 AND o.order_status IN ('delivered', 'shipped', 'approved') GROUP BY 1, 2""")
piece("acquisition", "closed_deals mql", """
SELECT d.mql_id, d.seller_id, CASE WHEN business_segment <> '' THEN business_segment ELSE 'unknown' END AS business_segment,
       CASE WHEN lead_type <> '' THEN lead_type ELSE 'unknown' END AS lead_type,
       CASE WHEN lead_behaviour_profile <> '' THEN lead_behaviour_profile ELSE 'unknown' END AS lead_behaviour_profile,
       CASE WHEN business_type <> '' THEN business_type ELSE 'unknown' END AS business_type,
       m.first_contact_date, d.won_date, CAST(coalesce(d.won_date - m.first_contact_date, 0) AS INT) AS days_to_close,
       coalesce(declared_monthly_revenue, 0) AS declared_monthly_revenue
FROM closed_deals d LEFT JOIN mql m ON d.mql_id = m.mql_id""")
piece("seller_perf", "order_items completed sellers order_reviews category", f"""
WITH rv AS (SELECT order_id, avg(review_score) AS score FROM order_reviews GROUP BY order_id)
SELECT i.seller_id, coalesce(s.seller_state, '') AS seller_state, coalesce(s.seller_city, '') AS seller_city,
       count(DISTINCT i.order_id) AS total_orders, {money('price')} AS total_revenue, {money('price')} / count(price) AS avg_order_value,
       {mean('coalesce(rv.score, 0)')} AS avg_review_score, count(DISTINCT coalesce(category_en, 'unknown')) AS unique_categories,
       count(price) AS total_items_sold
FROM order_items i LEFT JOIN sellers s ON i.seller_id = s.seller_id LEFT JOIN rv ON i.order_id = rv.order_id
LEFT JOIN category c ON i.product_id = c.product_id
WHERE i.order_id IN (SELECT order_id FROM completed) GROUP BY 1, 2, 3""")
piece("repeat_customer", "completed customers profile", """
WITH g AS (SELECT customer_unique_id, customer_state, count(order_id) AS total_orders, min(order_purchase_timestamp) AS a, max(order_purchase_timestamp) AS z
           FROM completed o JOIN customers c ON o.customer_id = c.customer_id GROUP BY 1, 2),
     k AS (SELECT *, row_number() OVER (PARTITION BY customer_unique_id ORDER BY customer_state DESC) AS rn FROM g)
SELECT k.customer_unique_id, k.customer_state, k.total_orders, CAST(k.total_orders > 1 AS INT) AS is_repeat_customer,
       CAST(a AS DATE) AS first_order_date, CAST(z AS DATE) AS last_order_date,
       CAST(floor((epoch(z) - epoch(a)) / 86400) AS INT) AS days_active, coalesce(p.is_high_value, 0) AS is_high_value
FROM k LEFT JOIN profile p ON k.customer_unique_id = p.customer_unique_id WHERE rn = 1""")
piece("price_range", "order_items completed category", f"""
SELECT strftime(o.order_purchase_timestamp, '%Y-%m') AS year_month, coalesce(c.category_en, 'unknown') AS product_category_en,
       CASE WHEN price <= 50 THEN 'A. 0-50' WHEN price <= 150 THEN 'B. 50-150' WHEN price <= 500 THEN 'C. 150-500' ELSE 'D. 500+' END AS price_bucket,
       count(i.order_id) AS order_count, {money('price')} AS total_revenue, {money('price')} / count(price) AS avg_price
FROM order_items i JOIN completed o ON i.order_id = o.order_id LEFT JOIN category c ON i.product_id = c.product_id GROUP BY 1, 2, 3""")
piece("review_segment", "v_orders customers order_reviews order_mode profile", """
WITH f AS (SELECT coalesce(p.is_high_value, 0) AS is_high_value, coalesce(m.payment_type, 'unknown') AS payment_type, c.customer_state,
                  coalesce(r.review_score, 0) AS score,
                  coalesce(floor((epoch(o.order_delivered_customer_date) - epoch(o.order_purchase_timestamp)) / 86400), 0) AS days,
                  CAST(coalesce(o.order_delivered_customer_date > o.order_estimated_delivery_date, false) AS INT) AS late
           FROM v_orders o JOIN customers c ON o.customer_id = c.customer_id LEFT JOIN order_reviews r ON o.order_id = r.order_id
           LEFT JOIN order_mode m ON o.order_id = m.order_id LEFT JOIN profile p ON c.customer_unique_id = p.customer_unique_id)
SELECT is_high_value, payment_type, customer_state, avg(score) AS avg_review_score, count(score) AS total_reviews,
       count(*) FILTER (score = 5) / count(*) * 100 AS pct_5star, count(*) FILTER (score = 1) / count(*) * 100 AS pct_1star,
       avg(days) AS avg_delivery_days, avg(late) AS late_delivery_rate
FROM f GROUP BY 1, 2, 3""")
piece("leads", "mql acquisition", """
SELECT m.mql_id, CASE WHEN origin <> '' THEN origin ELSE 'unknown' END AS origin, m.first_contact_date,
       a.days_to_close, a.business_segment, CAST(a.mql_id IS NOT NULL AS INT) AS converted
FROM mql m LEFT JOIN acquisition a ON m.mql_id = a.mql_id""")
piece("funnel", "leads", """
WITH top AS (SELECT origin, business_segment FROM (
               SELECT origin, business_segment, row_number() OVER (PARTITION BY origin ORDER BY count(*) DESC, business_segment) AS rn
               FROM leads WHERE converted = 1 GROUP BY 1, 2) WHERE rn = 1)
SELECT l.origin, count(mql_id) AS total_leads, CAST(sum(converted) AS BIGINT) AS converted_leads,
       round_even(sum(converted) / count(mql_id) * 100, 2) AS conversion_rate,
       coalesce(avg(days_to_close) FILTER (days_to_close > 0), 0) AS avg_days_to_close,
       coalesce(any_value(top.business_segment), 'unknown') AS top_business_segment
FROM leads l LEFT JOIN top ON l.origin = top.origin GROUP BY l.origin""")
piece("mql_monthly", "leads", """
SELECT strftime(first_contact_date, '%Y-%m') AS year_month, origin, count(mql_id) AS total_leads,
       CAST(sum(converted) AS BIGINT) AS converted_leads, round_even(sum(converted) / count(mql_id) * 100, 2) AS conversion_rate
FROM leads GROUP BY 1, 2""")
piece("behaviour", "acquisition", f"""
WITH top AS (SELECT lead_behaviour_profile, business_segment FROM (
               SELECT lead_behaviour_profile, business_segment,
                      row_number() OVER (PARTITION BY lead_behaviour_profile ORDER BY count(*) DESC, business_segment) AS rn
               FROM acquisition GROUP BY 1, 2) WHERE rn = 1)
SELECT a.lead_behaviour_profile, count(mql_id) AS total_deals, avg(days_to_close) AS avg_days_to_close,
       {money('declared_monthly_revenue')} / count(*) AS avg_declared_revenue, any_value(top.business_segment) AS top_business_segment
FROM acquisition a JOIN top ON a.lead_behaviour_profile = top.lead_behaviour_profile GROUP BY a.lead_behaviour_profile""")
piece("leakage", "detail", f"""
WITH g AS (SELECT customer_state AS state, payment_type, count(total_payment_value) AS order_count,
                  {money('total_payment_value')} / count(total_payment_value) AS avg_value FROM detail GROUP BY 1, 2),
     n AS (SELECT {money('total_payment_value')} / count(total_payment_value) AS nat FROM detail)
SELECT DATE '2024-02-01' AS analysis_date, state, payment_type, order_count, avg_value,
       greatest((nat - avg_value) / nat * order_count, 0) AS leakage_score
FROM g, n""")

MART_PIECES = {
    "mart_customer_payment_profile": "profile",
    "mart_order_payment_detail": "detail",
    "mart_seller_acquisition": "acquisition",
    "mart_seller_performance": "seller_perf",
    "mart_product_price_range": "price_range",
    "mart_geo_payment_summary": "geo",
    "mart_monthly_revenue": "monthly",
    "mart_payment_leakage": "leakage",
    "mart_hv_category_preference": "hv_category",
    "mart_repeat_customer": "repeat_customer",
    "mart_review_by_segment": "review_segment",
    "mart_mql_funnel": "funnel",
    "mart_mql_monthly": "mql_monthly",
    "mart_lead_behaviour": "behaviour",
}
# a column of each mart to add up
MART_AMOUNTS = {
    "mart_customer_payment_profile": "total_spend",
    "mart_order_payment_detail": "total_payment_value",
    "mart_seller_acquisition": "declared_monthly_revenue",
    "mart_seller_performance": "total_revenue",
    "mart_product_price_range": "total_revenue",
    "mart_geo_payment_summary": "total_revenue",
    "mart_monthly_revenue": "total_revenue",
    "mart_payment_leakage": "leakage_score",
    "mart_hv_category_preference": "total_spend",
    "mart_repeat_customer": "total_orders",
    "mart_review_by_segment": "total_reviews",
    "mart_mql_funnel": "total_leads",
    "mart_mql_monthly": "total_leads",
    "mart_lead_behaviour": "total_deals",
}
ORACLES: dict[str, str] = {
    "mart_customer_payment_profile": with_pieces("profile", "SELECT * FROM profile"),
    "mart_order_payment_detail": with_pieces("detail", "SELECT * FROM detail"),
    "mart_geo_payment_summary": with_pieces("geo", "SELECT * FROM geo"),
    "mart_monthly_revenue": with_pieces("monthly", "SELECT * FROM monthly"),
    "mart_hv_category_preference": with_pieces("hv_category", "SELECT * FROM hv_category"),
    "mart_seller_acquisition": with_pieces("acquisition", "SELECT * FROM acquisition"),
    "mart_seller_performance": with_pieces("seller_perf", "SELECT * FROM seller_perf"),
    "mart_repeat_customer": with_pieces("repeat_customer", "SELECT * FROM repeat_customer"),
    "mart_product_price_range": with_pieces("price_range", "SELECT * FROM price_range"),
    "mart_review_by_segment": with_pieces("review_segment", "SELECT * FROM review_segment"),
    "mart_mql_funnel": with_pieces("funnel", "SELECT * FROM funnel"),
    "mart_mql_monthly": with_pieces("mql_monthly", "SELECT * FROM mql_monthly"),
    "mart_lead_behaviour": with_pieces("behaviour", "SELECT * FROM behaviour"),
    "mart_payment_leakage": with_pieces("leakage", "SELECT * FROM leakage"),
}

# ---------------------------------------------------------------- ingest
ORACLES |= {
    "ingest_normalize": """
SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type ELSE '' END AS origin,
       CASE WHEN event_id % 3 = 0 THEN '' WHEN value > 100 THEN 'True' ELSE 'False' END AS has_company,
       CASE WHEN event_id % 5 <> 0 THEN value END AS declared_monthly_revenue
FROM events""",
    "rename_columns": """
SELECT p_partkey AS product_id, CAST(length(p_name) AS INT) AS product_name_length, p_size AS product_description_length FROM part""",
    "dq_report": with_pieces("v_orders order_payments customers products order_items", """
, c AS (
  SELECT 'orders' AS table_name, 'not empty' AS rule, count(*) AS row_count, CAST(count(*) = 0 AS BIGINT) AS violations FROM v_orders
  UNION ALL SELECT 'orders', 'order_id not null', count(*), count(*) FILTER (order_id IS NULL) FROM v_orders
  UNION ALL SELECT 'orders', 'customer_id not null', count(*), count(*) FILTER (customer_id IS NULL) FROM v_orders
  UNION ALL SELECT 'order_payments', 'not empty', count(*), CAST(count(*) = 0 AS BIGINT) FROM order_payments
  UNION ALL SELECT 'order_payments', 'payment_value not negative', count(*), count(*) FILTER (payment_value < 0 OR payment_value IS NULL) FROM order_payments
  UNION ALL SELECT 'customers', 'not empty', count(*), CAST(count(*) = 0 AS BIGINT) FROM customers
  UNION ALL SELECT 'products', 'not empty', count(*), CAST(count(*) = 0 AS BIGINT) FROM products
  UNION ALL SELECT 'products', 'product_category_name not null', count(*), count(*) FILTER (product_category_name IS NULL) FROM products
  UNION ALL SELECT 'order_items', 'not empty', count(*), CAST(count(*) = 0 AS BIGINT) FROM order_items
  UNION ALL SELECT 'order_items', 'order_id not null', count(*), count(*) FILTER (order_id IS NULL) FROM order_items
  UNION ALL SELECT 'orders', 'every line readable', count(*), 0 FROM v_orders
  UNION ALL SELECT 'order_payments', 'every line readable', count(*), 0 FROM order_payments
  UNION ALL SELECT 'customers', 'every line readable', count(*), 0 FROM customers
  UNION ALL SELECT 'products', 'every line readable', count(*), 0 FROM products
  UNION ALL SELECT 'order_items', 'every line readable', count(*), 0 FROM order_items
  UNION ALL SELECT 'order_items', 'price not negative', count(*), count(*) FILTER (price < 0 OR price IS NULL) FROM order_items)
SELECT *, CAST(violations = 0 AS INT) AS passed FROM c"""),
    "latest_by_key": """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "ensure_columns": "SELECT *, CAST(0 AS DOUBLE) AS avg_review_score, '' AS installment_bucket FROM customer",
}

# ---------------------------------------------------------------- channels and leads
piece("channel", "leads", """
WITH g AS (SELECT origin, count(*) AS total_leads, CAST(sum(converted) AS BIGINT) AS converted_leads FROM leads GROUP BY origin),
     s AS (SELECT *, round_even(converted_leads / total_leads * 100, 2) AS conversion_rate_pct, round_even(ln(total_leads + 1), 4) AS log_volume FROM g),
     e AS (SELECT *, round_even(converted_leads / total_leads * log_volume, 6) AS efficiency_score FROM s)
SELECT *, CAST(row_number() OVER (ORDER BY efficiency_score DESC, origin) AS INT) AS rank,
       round_even(efficiency_score / sum(efficiency_score) OVER () * 100, 1) AS budget_allocation_pct
FROM e""")
# the action texts, as in the published channel report
ORACLES["channel_efficiency"] = with_pieces("channel", """
SELECT *, CASE WHEN origin = 'unknown' THEN 'P0 - Fix UTM tracking (Week 1)' WHEN rank IN (1, 2) THEN 'P1 - Scale now'
               WHEN rank IN (3, 4) THEN 'P2 - Maintain and monitor' ELSE 'P3 - Reduce and reallocate' END AS action_priority,
       CASE WHEN origin = 'unknown' THEN 'FIX UTM FIRST - 16.7% conversion but 0% attribution. Enforce UTM params on all landing pages before any spend increase.'
            WHEN efficiency_score = 0 THEN 'PAUSE - Zero efficiency. Investigate before any new spend.'
            WHEN rank <= 2 THEN 'INCREASE - Rank ' || rank || ' by efficiency. Scale budget 20-30%.'
            WHEN rank <= 4 THEN 'MAINTAIN - Solid efficiency. Review quarterly.'
            ELSE 'REDUCE - Below-median efficiency. Reallocate to Rank 1-2 channels. A/B test creative before cutting.' END AS recommendation
FROM channel""")
ORACLES["profile_close_time"] = with_pieces("acquisition", """
, s AS (SELECT lead_behaviour_profile, count(seller_id) AS seller_count, round_even(avg(days_to_close), 1) AS avg_days_to_close,
               round_even(quantile_cont(days_to_close, 0.5), 1) AS median_days_to_close, min(days_to_close) AS min_days, max(days_to_close) AS max_days
        FROM acquisition WHERE lead_behaviour_profile <> 'unknown' GROUP BY 1)
SELECT *, CASE WHEN avg_days_to_close < 45 THEN 'Fast-Track (<45 days)' WHEN avg_days_to_close < 90 THEN 'Standard Nurture (45-90 days)'
               ELSE 'High-Touch Support (>90 days)' END AS onboarding_package FROM s""")
ORACLES["segment_distribution"] = with_pieces("acquisition", """
, s AS (SELECT business_segment, count(seller_id) AS converted_count, round_even(avg(days_to_close), 1) AS avg_days,
               round_even(avg(CAST(business_type = 'reseller' AS INT)) * 100, 1) AS pct_resellers
        FROM acquisition WHERE business_segment <> 'unknown' GROUP BY 1)
SELECT *, round_even(converted_count / sum(converted_count) OVER () * 100, 1) AS platform_share_pct FROM s""")
ORACLES["profile_onboarding_packages"] = with_pieces("acquisition", """
, s AS (SELECT lead_behaviour_profile, count(seller_id) AS count, round_even(avg(days_to_close), 1) AS avg_days
        FROM acquisition WHERE lead_behaviour_profile <> 'unknown' GROUP BY 1)
SELECT *, CASE lead_behaviour_profile
            WHEN 'eagle' THEN 'Fast-Track - dedicated SDR, 7-day onboarding, priority listing'
            WHEN 'cat' THEN 'Fast-Track - structured 2-week onboarding, category advisor'
            WHEN 'wolf' THEN 'Standard Nurture - 90-day drip sequence, bi-weekly check-in'
            WHEN 'shark' THEN 'High-Touch Support - 60-day intensive, legal/compliance review'
            ELSE 'Standard Nurture - default 60-day sequence' END AS onboarding_package FROM s""")

# ---------------------------------------------------------------- points
piece("customer_points", "profile hv_category repeat_customer", """
WITH b AS (SELECT p.customer_unique_id, p.customer_state, customer_city, total_spend, p.is_high_value, preferred_payment_type, installment_bucket,
                  max_installments_used, uses_installments, avg_review_score, p.total_orders, round_even(total_spend, 2) AS base_points,
                  CASE installment_bucket WHEN '12+' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS installment_mult,
                  CASE WHEN p.customer_unique_id IN (SELECT customer_unique_id FROM hv_category WHERE product_category_en IN ('standard', 'large', 'medium'))
                       THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS category_mult,
                  CASE WHEN p.customer_state IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_4') THEN 1.2::DOUBLE ELSE 1.0::DOUBLE END AS frontier_mult,
                  CASE WHEN avg_review_score > 0 AND p.total_orders >= 1 THEN 50 ELSE 0 END AS review_bonus,
                  coalesce(r.is_repeat_customer, 0) AS is_repeat_customer
           FROM profile p LEFT JOIN repeat_customer r ON p.customer_unique_id = r.customer_unique_id),
     t AS (SELECT *, round_even(base_points * installment_mult * category_mult * frontier_mult + review_bonus, 0) AS total_points FROM b),
     u AS (SELECT *, CASE WHEN total_points >= 100000 THEN 'Platinum' WHEN total_points >= 60000 THEN 'Gold'
                          WHEN total_points >= 35000 THEN 'Silver' ELSE 'Bronze' END AS tier FROM t)
SELECT *, CASE tier WHEN 'Bronze' THEN 'Silver' WHEN 'Silver' THEN 'Gold' ELSE 'Platinum' END AS next_tier,
       greatest(CASE tier WHEN 'Bronze' THEN 60000 ELSE 100000 END - total_points, 0) AS points_to_next,
       CASE WHEN is_high_value = 1 AND is_repeat_customer = 1 THEN 'HVC Loyal' WHEN is_high_value = 1 AND is_repeat_customer = 0 THEN 'HVC One-Time'
            WHEN is_high_value = 0 AND installment_bucket <> '1' THEN 'RC Upgrade Path' ELSE 'RC Single-Pay' END AS marketing_audience
FROM u""")
piece("seller_points", "seller_perf", """
WITH b AS (SELECT *, round_even(avg_review_score * 100 * total_orders, 0) AS base_points,
                  CASE WHEN avg_order_value > 535 THEN 1.3::DOUBLE ELSE 1.0::DOUBLE END AS category_bonus FROM seller_perf),
     t AS (SELECT *, round_even(base_points * category_bonus, 0) AS total_points FROM b),
     u AS (SELECT *, CASE WHEN total_points >= 32000 THEN 'Platinum' WHEN total_points >= 27000 THEN 'Gold'
                          WHEN total_points >= 23000 THEN 'Silver' ELSE 'Bronze' END AS tier,
                     CASE WHEN total_revenue <= 202000 THEN 'Starter' WHEN total_revenue <= 217000 THEN 'Growth' ELSE 'Premium' END AS revenue_tier FROM t)
SELECT *, CASE revenue_tier WHEN 'Starter' THEN 'Basic listing + onboarding analytics + category page placement'
                            WHEN 'Growth' THEN 'Featured product slots + keyword-targeted display + enhanced analytics'
                            ELSE 'Banner ads + HVC segment targeting + cross-sell placements + account manager' END AS ad_package,
       round_even(total_points * 0.1::DOUBLE, 2) AS ad_credit_value,
       CASE tier WHEN 'Bronze' THEN 'Silver' WHEN 'Silver' THEN 'Gold' ELSE 'Platinum' END AS next_tier,
       greatest(CASE tier WHEN 'Bronze' THEN 27000 ELSE 32000 END - total_points, 0) AS points_to_next
FROM u""")
ORACLES |= {
    "customer_points": with_pieces("customer_points", "SELECT * FROM customer_points"),
    "seller_points": with_pieces("seller_points", "SELECT * FROM seller_points"),
    "tier_summary": with_pieces("customer_points seller_points", """
, lv AS (SELECT unnest(['Platinum', 'Gold', 'Silver', 'Bronze']) AS tier),
  c AS (SELECT tier, count(*) AS n, avg(total_points) AS p, avg(is_high_value) AS h FROM customer_points GROUP BY tier),
  s AS (SELECT tier, count(*) AS n, avg(total_points) AS p, avg(ad_credit_value) AS k FROM seller_points GROUP BY tier)
SELECT lv.tier, coalesce(c.n, 0) AS customer_count,
       round_even(coalesce(c.n, 0) / (SELECT count(*) FROM customer_points) * 100, 1) AS customer_pct,
       coalesce(round_even(c.p, 0), 0) AS avg_customer_points, coalesce(round_even(c.h * 100, 1), 0) AS hvc_in_tier_pct,
       coalesce(s.n, 0) AS seller_count, round_even(coalesce(s.n, 0) / (SELECT count(*) FROM seller_points) * 100, 1) AS seller_pct,
       coalesce(round_even(s.p, 0), 0) AS avg_seller_points, coalesce(round_even(s.k, 2), 0) AS avg_seller_ad_credit
FROM lv LEFT JOIN c ON lv.tier = c.tier LEFT JOIN s ON lv.tier = s.tier"""),
    "installment_impact": with_pieces("customer_points", """
SELECT installment_bucket, count(*) AS customers, round_even(avg(base_points), 1) AS avg_base_points,
       round_even(avg(total_points), 1) AS avg_total_points FROM customer_points GROUP BY 1"""),
    "audience_distribution": with_pieces("customer_points", """
SELECT marketing_audience, count(*) AS customer_count, round_even(count(*) / sum(count(*)) OVER () * 100, 1) AS pct
FROM customer_points GROUP BY 1"""),
}

# ---------------------------------------------------------------- leakage
piece("alerts", "leakage", """
WITH a AS (SELECT *, CASE WHEN avg_value = 0 THEN 0 ELSE round_even((2120 - avg_value) / 2120 * 100, 2) END AS pct_below_national_avg,
                  CASE WHEN leakage_score >= 12 THEN 'CRITICAL' WHEN leakage_score >= 6 THEN 'HIGH'
                       WHEN leakage_score >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
                  round_even(abs(least(avg_value - 2120, 0)) * order_count, 2) AS revenue_at_risk
           FROM leakage WHERE leakage_score > 0)
SELECT *, pct_below_national_avg > 5 AS alert_flag,
       CASE WHEN payment_type IN ('not_defined', 'unknown')
            THEN 'CRITICAL ROUTING ERROR - ' || payment_type || ' linked to review scores 1.0-1.67. Escalate to payment ops. Manual review within 24h SLA.'
            WHEN payment_type = 'credit_card' AND leakage_score > 6
            THEN 'Push 12-installment plan for ' || state || ' credit card orders above R$ 2200.00. ' || printf('%.1f', pct_below_national_avg)
                 || '% below national avg across ' || format('{:,}', order_count) || ' transactions.'
            WHEN payment_type = 'boleto' AND leakage_score > 4
            THEN 'Offer ' || state || ' boleto customers credit-card-with-installment upgrade at checkout. ' || printf('%.1f', pct_below_national_avg) || '% below national avg.'
            WHEN pct_below_national_avg > 10
            THEN state || ' ' || payment_type || ': ' || printf('%.1f', pct_below_national_avg) || '% below national avg. Investigate checkout flow for friction points.'
            ELSE state || ' ' || payment_type || ': ' || printf('%.1f', pct_below_national_avg) || '% below national avg. Monitor weekly.' END AS remediation,
       CAST(row_number() OVER (ORDER BY leakage_score DESC, state, payment_type) AS INT) AS alert_rank
FROM a""")
ORACLES |= {
    "leakage_alerts": with_pieces("alerts", "SELECT * FROM alerts"),
    "leakage_state_summary": with_pieces("alerts", f"""
, g AS (SELECT state, {money('leakage_score')} AS s, CAST(sum(order_count) AS BIGINT) AS total_orders_affected, {money('revenue_at_risk')} AS r,
               count(payment_type) AS num_payment_types, arg_min(payment_type, alert_rank) AS worst_payment_type, max(pct_below_national_avg) AS m
        FROM alerts GROUP BY state)
SELECT state, round_even(s, 2) AS total_leakage_score, total_orders_affected, round_even(r, 2) AS total_revenue_at_risk, num_payment_types,
       worst_payment_type, round_even(m, 2) AS highest_pct_below, CAST(row_number() OVER (ORDER BY s DESC, state) AS INT) AS state_rank FROM g"""),
    "leakage_critical": with_pieces("alerts", """
SELECT state, payment_type, order_count, avg_value, remediation FROM alerts WHERE payment_type IN ('not_defined', 'unknown')"""),
    "national_avg_check": with_pieces("detail", f"""
SELECT 2120::DOUBLE AS configured_avg, {money('total_payment_value')} / count(*) AS live_avg,
       {money('total_payment_value')} / count(*) - 2120 AS difference FROM detail"""),
}

# ---------------------------------------------------------------- campaign timing
piece("seasons", "", """
SELECT unnest(range(1, 13)) AS m, unnest(['Liquidação de Janeiro / Summer clearance', 'Carnaval season - electronics + fashion pre-event',
  'Back-to-school close / Easter prep', 'Páscoa (Easter) - chocolate, home, gifts', 'Dia das Mães (2nd Sunday) - biggest gifting event after BF',
  'Dia dos Namorados (June 12) - beauty, jewelry, electronics', 'Férias de julho - travel, toys, leisure',
  'Dia dos Pais (2nd Sunday) - electronics, tools, sports', 'Volta às aulas / Spring promo', 'Dia das Crianças (Oct 12) - toys, games, apparel',
  'Black Friday - highest sales event of the year', 'Natal / Christmas + end-of-year clearance']) AS event""")
piece("calendar", "monthly seasons", f"""
WITH t AS (SELECT year_month, {money('total_revenue')} AS rev, sum(order_count) AS n FROM monthly GROUP BY 1),
     s AS (SELECT CAST(substr(year_month, 6, 2) AS INT) AS m, rev, n,
                  round_even((rank() OVER (ORDER BY rev) + (count(*) OVER (PARTITION BY rev) - 1) / 2) / count(*) OVER () * 9 + 1, 1) AS score FROM t),
     c AS (SELECT m, round_even({money('rev')} / count(*), 0) AS avg_revenue, round_even(sum(n) / count(*), 0) AS avg_orders,
                  round_even(sum(CAST(round_even(score * 10, 0) AS BIGINT)) / (count(*) * 10), 1) AS intensity_score, count(*) AS data_points FROM s GROUP BY m)
SELECT c.m AS calendar_month, monthname(make_date(2000, c.m, 1)) AS month_name, intensity_score,
       CASE WHEN intensity_score >= 8 THEN 'HIGH' WHEN intensity_score >= 5 THEN 'MEDIUM' ELSE 'LOW' END AS intensity_band,
       seasons.event AS seasonal_event,
       CASE WHEN intensity_score >= 8 THEN 21 WHEN intensity_score >= 5 THEN 14 ELSE 7 END AS pre_launch_days,
       intensity_score >= 7 AS flash_sale_flag, avg_revenue, avg_orders,
       round_even(round_even(intensity_score * 10, 0) / sum(round_even(intensity_score * 10, 0)) OVER () * 100, 1) AS campaign_budget_weight, data_points
FROM c JOIN seasons ON seasons.m = c.m""")
ORACLES |= {
    "campaign_calendar": with_pieces("calendar", "SELECT * FROM calendar"),
    "category_timing": with_pieces("price_range seasons", f"""
, g AS (SELECT product_category_en AS category, CAST(substr(year_month, 6, 2) AS INT) AS m, {money('total_revenue')} AS rev
        FROM price_range WHERE product_category_en IN ('standard', 'large', 'medium') GROUP BY 1, 2),
  r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY rev DESC, m) AS rn FROM g)
SELECT category, string_agg(monthname(make_date(2000, r.m, 1)), ', ' ORDER BY rn) AS peak_months,
       '[' || string_agg(CAST(r.m AS VARCHAR), ', ' ORDER BY rn) || ']' AS peak_month_nums,
       round_even(max(rev), 0) AS top_month_revenue, arg_min(monthname(make_date(2000, r.m, 1)), rn) AS top_month,
       arg_min(seasons.event, rn) AS seasonal_event
FROM r JOIN seasons ON seasons.m = r.m WHERE rn <= 3 GROUP BY category"""),
    "flash_sale_windows": with_pieces("calendar", """
SELECT calendar_month, month_name, intensity_score, seasonal_event,
       CASE WHEN intensity_score >= 9 THEN 'Major Flash Event (48-72h)' ELSE 'Standard Flash Sale (24h)' END AS flash_sale_type,
       CASE intensity_band WHEN 'HIGH' THEN 'Week 2 and Week 4 of the month' WHEN 'MEDIUM' THEN 'Week 3 of the month' END AS recommended_window,
       CASE WHEN intensity_score >= 9 THEN 'Push + Email + Display + Retargeting' ELSE 'Email + Display' END AS channel_priority,
       campaign_budget_weight
FROM calendar WHERE flash_sale_flag"""),
    "campaign_band_budget": with_pieces("calendar", """
SELECT b AS intensity_band, count(calendar_month) AS month_count,
       coalesce(sum(CAST(round_even(campaign_budget_weight * 10, 0) AS BIGINT)) / 10, 0) AS budget_pct,
       coalesce(string_agg(month_name, ', ' ORDER BY calendar_month), '') AS months
FROM (SELECT unnest(['HIGH', 'MEDIUM', 'LOW']) AS b) LEFT JOIN calendar ON intensity_band = b GROUP BY b"""),
}

# ---------------------------------------------------------------- triggers, audiences, headline figures
piece("triggers", "profile repeat_customer", """
WITH f AS (SELECT p.*, r.is_repeat_customer, r.days_active, (SELECT quantile_cont(avg_order_value, 0.5) FROM profile) AS med
           FROM profile p LEFT JOIN repeat_customer r ON p.customer_unique_id = r.customer_unique_id),
     t AS (SELECT customer_unique_id, customer_state, is_high_value, preferred_payment_type, avg_order_value, total_orders,
                  CAST(total_orders >= 1 AS INT) AS T1_post_purchase_review,
                  CAST(coalesce(preferred_payment_type = 'boleto' AND avg_order_value > 2200, false) AS INT) AS T2_installment_upgrade,
                  CAST(coalesce(preferred_payment_type = 'voucher' AND avg_order_value > med, false) AS INT) AS T3_payment_anomaly,
                  CAST(coalesce(is_repeat_customer = 0 AND days_active = 0 AND total_orders = 1, false) AS INT) AS T4_re_engagement,
                  CAST(coalesce(is_high_value = 1 AND uses_installments = 0 AND avg_order_value > 2200, false) AS INT) AS T5_hvc_upsell FROM f)
SELECT *, T1_post_purchase_review + T2_installment_upgrade + T3_payment_anomaly + T4_re_engagement + T5_hvc_upsell AS active_triggers FROM t""")
piece("audiences", "profile repeat_customer hv_category", """
WITH top AS (SELECT customer_unique_id, product_category_en FROM (
               SELECT *, row_number() OVER (PARTITION BY customer_unique_id ORDER BY total_spend DESC, product_category_en) AS rn FROM hv_category) WHERE rn = 1),
     f AS (SELECT p.customer_unique_id, p.customer_state, p.is_high_value, r.is_repeat_customer, total_spend, avg_order_value, preferred_payment_type,
                  uses_installments, coalesce(top.product_category_en, 'unknown') AS top_category
           FROM profile p LEFT JOIN repeat_customer r ON p.customer_unique_id = r.customer_unique_id
           LEFT JOIN top ON p.customer_unique_id = top.customer_unique_id),
     g AS (SELECT *, CAST(top_category IN ('standard', 'large', 'medium') AS INT) AS is_hvc_category,
                  CASE WHEN is_high_value = 1 AND is_repeat_customer = 1 THEN 'hvc_loyal' WHEN is_high_value = 1 AND is_repeat_customer = 0 THEN 'hvc_one_time'
                       WHEN is_repeat_customer = 1 AND is_high_value = 0 THEN 'rc_upgrade_path' ELSE 'rc_single_pay' END AS audience_segment FROM f)
SELECT *, CASE audience_segment
  WHEN 'hvc_loyal' THEN 'Exclusive early access to Black Friday + Dia das Mães campaigns. 12-installment option pre-surfaced. Dedicated retention email cadence (bi-weekly).'
  WHEN 'hvc_one_time' THEN 'Win-back campaign at 30d post-purchase. Personalized category recommendation based on first-order category. Incentivize second order with 10% category voucher.'
  WHEN 'rc_upgrade_path' THEN 'Upgrade to installment plan at next checkout. Show HVC threshold progress (''R$X away from HVC status''). Target with mid-tier category upsell (C. 150-500 bucket).'
  ELSE 'Credit card + installment education email. Low-value promotional entry offer to encourage repeat. Re-engagement trigger at 90 days inactivity.' END AS audience_strategy
FROM g""")
ORACLES |= {
    "trigger_segments": with_pieces("triggers", """
SELECT *, CASE WHEN T1_post_purchase_review = 1 THEN 'T1_post_purchase_review' WHEN T2_installment_upgrade = 1 THEN 'T2_installment_upgrade'
               WHEN T3_payment_anomaly = 1 THEN 'T3_payment_anomaly' WHEN T4_re_engagement = 1 THEN 'T4_re_engagement'
               WHEN T5_hvc_upsell = 1 THEN 'T5_hvc_upsell' ELSE 'none' END AS primary_trigger,
       CASE WHEN T1_post_purchase_review = 1 THEN 'Send review request email 5 days after estimated delivery. If review score >= 4, surface upsell recommendation.'
            WHEN T2_installment_upgrade = 1 THEN 'At next checkout: display credit card + 6-installment option side-by-side with boleto. Show monthly installment value prominently.'
            WHEN T3_payment_anomaly = 1 THEN 'Flag to customer ops within 24h. Send payment method clarification email. Offer credit card as preferred fallback.'
            WHEN T4_re_engagement = 1 THEN 'Day 90: re-engagement email with top category deals. Day 105: SMS/push with discount code. Day 120: final win-back offer before suppression.'
            WHEN T5_hvc_upsell = 1 THEN 'Surface 12-installment plan at checkout. Add loyalty point multiplier badge to product page. Invite to HVC early-access sale event.'
            ELSE 'No action' END AS trigger_action
FROM triggers"""),
    "trigger_summary": with_pieces("triggers", """
, u AS (UNPIVOT (SELECT sum(T1_post_purchase_review) AS T1_post_purchase_review, sum(T2_installment_upgrade) AS T2_installment_upgrade,
                 sum(T3_payment_anomaly) AS T3_payment_anomaly, sum(T4_re_engagement) AS T4_re_engagement, sum(T5_hvc_upsell) AS T5_hvc_upsell,
                 CAST(count(*) FILTER (active_triggers > 0) AS HUGEINT) AS at_least_one, CAST(count(*) FILTER (active_triggers > 1) AS HUGEINT) AS at_least_two FROM triggers)
        ON COLUMNS(*) INTO NAME trigger VALUE n)
SELECT trigger, CAST(n AS BIGINT) AS customer_count, round_even(n / (SELECT count(*) FROM triggers) * 100, 1) AS pct FROM u"""),
    "audience_segments": with_pieces("audiences", "SELECT * FROM audiences"),
    "segment_summary": with_pieces("audiences", """
SELECT audience_segment, count(*) AS customer_count, round_even(avg(total_spend), 0) AS avg_spend, round_even(avg(avg_order_value), 1) AS avg_order_value,
       round_even(avg(CAST(preferred_payment_type = 'credit_card' AS INT)) * 100, 1) AS pct_credit_card,
       round_even(avg(uses_installments), 3) AS pct_installments, round_even(avg(is_hvc_category), 3) AS pct_hvc_category,
       any_value(audience_strategy) AS strategy FROM audiences GROUP BY 1"""),
    "hvc_loyal_top_categories": with_pieces("audiences", """
SELECT top_category, count(*) AS customer_count FROM audiences WHERE audience_segment = 'hvc_loyal'
GROUP BY 1 ORDER BY customer_count DESC, top_category LIMIT 5"""),
    "executive_kpis": with_pieces("profile repeat_customer", f"""
SELECT 'hvc_spend_threshold' AS kpi, 'all' AS segment, quantile_cont(total_spend, 0.75) AS value FROM profile
UNION ALL SELECT 'hvc_customers', 'all', CAST(count(*) FILTER (is_high_value = 1) AS DOUBLE) FROM profile
UNION ALL SELECT 'hvc_customer_share', 'all', count(*) FILTER (is_high_value = 1) / count(*) FROM profile
UNION ALL SELECT 'hvc_revenue', 'all', {money('CASE WHEN is_high_value = 1 THEN total_spend END')} FROM profile
UNION ALL SELECT 'total_revenue', 'all', {money('total_spend')} FROM profile
UNION ALL SELECT 'hvc_revenue_share', 'all', {money('CASE WHEN is_high_value = 1 THEN total_spend END')} / {money('total_spend')} FROM profile
UNION ALL SELECT 'repeat_customer_rate', CASE WHEN is_high_value = 1 THEN 'high_value' ELSE 'regular' END, avg(is_repeat_customer) FROM repeat_customer GROUP BY 2
UNION ALL SELECT 'spend_per_order', installment_bucket, {money('total_spend')} / sum(total_orders) FROM profile GROUP BY 2"""),
}

# ---------------------------------------------------------------- model inputs
piece("lead_rows", "acquisition", """
SELECT mql_id, greatest(days_to_close, 0) AS days_to_close, lead_type, lead_behaviour_profile, business_segment, business_type,
       declared_monthly_revenue AS revenue, CAST(CAST('0x' || substr(md5('42:' || mql_id), 1, 8) AS BIGINT) % 5 AS INT) AS fold
FROM acquisition""")


def out_of_fold(column: str) -> str:
    return f"""(SELECT round_even(coalesce((sum(o.days_to_close) + 10 * (SELECT avg(days_to_close) FROM lead_rows)) / nullif(count(*) + 10, 10),
            (SELECT avg(days_to_close) FROM lead_rows)), 9) FROM lead_rows o WHERE o.{column} = r.{column} AND o.fold <> r.fold) AS {column}_enc"""


def mapping_of(column: str) -> str:
    return f"""SELECT '{column}' AS feature, {column} AS category, count(*) AS row_count,
       round_even((sum(days_to_close) + 10 * (SELECT avg(days_to_close) FROM lead_rows)) / (count(*) + 10), 9) AS encoded FROM lead_rows GROUP BY {column}"""


LEAD_CATEGORIES = ["lead_type", "lead_behaviour_profile", "business_segment", "business_type"]
ORACLES |= {
    "lead_features": with_pieces("lead_rows", """
SELECT mql_id, days_to_close, lead_type, lead_behaviour_profile, business_segment, business_type,
       round_even(ln(1 + revenue), 9) AS log_revenue, CAST(revenue > 0 AS INT) AS has_revenue FROM lead_rows"""),
    "target_encode_oof": with_pieces(
        "lead_rows", "SELECT mql_id, fold, days_to_close, " + ", ".join(map(out_of_fold, LEAD_CATEGORIES)) + " FROM lead_rows r"
    ),
    "target_encode_mapping": with_pieces("lead_rows", " UNION ALL ".join(map(mapping_of, LEAD_CATEGORIES))),
    "seller_cluster_features": with_pieces("seller_perf", """
, f AS (SELECT seller_id, ln(1 + total_revenue) AS a, avg_review_score AS b, ln(1 + total_orders) AS c, CAST(unique_categories AS DOUBLE) AS d FROM seller_perf),
  s AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(d) AS md, stddev_samp(a) AS sa, stddev_samp(b) AS sb, stddev_samp(c) AS sc, stddev_samp(d) AS sd FROM f)
SELECT seller_id, round_even(coalesce((a - ma) / nullif(sa, 0), 0), 6) AS z_log_revenue, round_even(coalesce((b - mb) / nullif(sb, 0), 0), 6) AS z_avg_review_score,
       round_even(coalesce((c - mc) / nullif(sc, 0), 0), 6) AS z_log_orders, round_even(coalesce((d - md) / nullif(sd, 0), 0), 6) AS z_unique_categories
FROM f, s"""),
    "installment_features": with_pieces("profile", """
, st AS (SELECT customer_state, CAST(row_number() OVER (ORDER BY customer_state) - 1 AS INT) AS i FROM (SELECT DISTINCT customer_state FROM profile))
SELECT customer_unique_id, st.i AS state_encoded,
       round_even(ln(1 + coalesce(avg_order_value, (SELECT quantile_cont(avg_order_value, 0.5) FROM profile))), 9) AS log_avg_order_value,
       round_even(ln(1 + total_orders), 9) AS log_total_orders, CAST(preferred_payment_type = 'credit_card' AS INT) AS is_credit_card, is_high_value,
       CAST(p.customer_state IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_4') AS INT) AS leakage_state, uses_installments
FROM profile p JOIN st ON st.customer_state = p.customer_state"""),
}

# ---------------------------------------------------------------- sources, sinks, folds
ORACLES |= {
    "raw_csv_customers": with_pieces("customers", """
SELECT CAST(customer_id AS VARCHAR) AS customer_id, CAST(customer_unique_id AS VARCHAR) AS customer_unique_id,
       lpad(CAST(customer_id % 100000 AS VARCHAR), 5, '0') AS customer_zip_code_prefix, customer_city, customer_state FROM customers"""),
    "raw_csv_orders": with_pieces("v_orders", """
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, order_status, order_purchase_timestamp,
       CAST(NULL AS TIMESTAMP) AS order_approved_at, CAST(NULL AS TIMESTAMP) AS order_delivered_carrier_date,
       order_delivered_customer_date, order_estimated_delivery_date FROM v_orders"""),
    "mart_csv_round_trip": with_pieces("monthly", "SELECT * FROM monthly"),
    "raw_csv_all": with_pieces("v_orders order_items order_payments customers products translation sellers order_reviews mql closed_deals", f"""
SELECT 'orders' AS input, count(*) AS row_count, count(order_id) AS keys, CAST(NULL AS DOUBLE) AS amount FROM v_orders
UNION ALL SELECT 'order_items', count(*), count(order_id), round_even({money('price + freight_value')}, 6) FROM order_items
UNION ALL SELECT 'order_payments', count(*), count(order_id), round_even({money('payment_value')}, 6) FROM order_payments
UNION ALL SELECT 'customers', count(*), count(customer_id), NULL FROM customers
UNION ALL SELECT 'products', count(*), count(product_id), NULL FROM products
UNION ALL SELECT 'category_translation', count(*), count(product_category_name), NULL FROM translation
UNION ALL SELECT 'sellers', count(*), count(seller_id), NULL FROM sellers
UNION ALL SELECT 'geolocation', count(*), count(c_custkey), round_even({money('c_acctbal / 100')}, 6) FROM customer
UNION ALL SELECT 'order_reviews', count(*), count(review_id), CAST(sum(review_score) AS DOUBLE) FROM order_reviews
UNION ALL SELECT 'mql', count(*), count(mql_id), NULL FROM mql
UNION ALL SELECT 'closed_deals', count(*), count(mql_id), round_even({money('declared_monthly_revenue')}, 6) FROM closed_deals"""),
    "mart_csv_all": with_pieces(" ".join(MART_PIECES.values()), "\nUNION ALL ".join(
        f"SELECT '{mart}' AS mart, count(*) AS row_count, round_even({money(f'CAST({MART_AMOUNTS[mart]} AS DOUBLE)')}, 6) AS total FROM {name}"
        for mart, name in MART_PIECES.items()
    )),
    "export_marts": with_pieces(" ".join(MART_PIECES.values()), "\nUNION ALL ".join(
        f"SELECT '{mart}' AS mart, count(*) AS row_count FROM {name}" for mart, name in MART_PIECES.items()
    )),
    "mart_versions": with_pieces("repeat_customer", """
SELECT * REPLACE (CASE WHEN total_orders > 6 THEN -1 ELSE days_active END AS days_active) FROM repeat_customer"""),
    "cross_validation_folds": with_pieces("profile", """
SELECT customer_unique_id, uses_installments,
       CAST((row_number() OVER (PARTITION BY uses_installments ORDER BY md5('42:' || customer_unique_id), customer_unique_id) - 1) % 5 AS INT) AS stratified_fold,
       CAST(CAST('0x' || substr(md5('42:' || customer_unique_id), 1, 8) AS BIGINT) % 5 AS INT) AS plain_fold
FROM profile"""),
}

# ---------------------------------------------------------------- rules behind the models, on a score of the key
def score(column: str) -> str:
    return f"(({column} * 7919 % 1009) / 1009::DOUBLE)"


piece("priorities", "acquisition", f"""
WITH p AS (SELECT *, {score('mql_id')} * 120 AS days FROM acquisition),
     g AS (SELECT lead_behaviour_profile, business_segment, row_number() OVER (PARTITION BY lead_behaviour_profile ORDER BY count(*) DESC, business_segment) AS rn
           FROM acquisition GROUP BY 1, 2),
     s AS (SELECT *, 1 - (days - min(days) OVER ()) / (max(days) OVER () - min(days) OVER ()) AS score FROM p)
SELECT s.* EXCLUDE (days, score), round_even(days, 1) AS predicted_days_to_close, round_even(score, 4) AS priority_score,
       CASE WHEN score <= 0.4 THEN 'LOW' WHEN score <= 0.7 THEN 'MEDIUM' ELSE 'HIGH' END AS priority_tier,
       g.business_segment AS predicted_segment,
       CASE WHEN days <= 45 THEN 'Fast-Track (<=45 days)' WHEN days <= 90 THEN 'Standard Nurture (<=90 days)' ELSE 'High-Touch Support (>90 days)' END AS onboarding_package
FROM s JOIN g ON s.lead_behaviour_profile = g.lead_behaviour_profile AND rn = 1""")
piece("cluster_tiers", "seller_perf", f"""
WITH c AS (SELECT *, CAST(seller_id % 3 AS INT) AS cluster FROM seller_perf),
     r AS (SELECT cluster, row_number() OVER (ORDER BY m, cluster) AS rn FROM (SELECT cluster, {mean('total_revenue')} AS m FROM c GROUP BY cluster))
SELECT seller_id, seller_state, seller_city, total_revenue, avg_review_score, total_orders, unique_categories, c.cluster,
       CASE rn WHEN 1 THEN 'Starter' WHEN 2 THEN 'Growth' ELSE 'Premium' END AS revenue_tier, CAST(avg_order_value > 535 AS INT) AS hvc_aligned,
       CASE rn WHEN 1 THEN 'Basic product listing | Onboarding analytics dashboard | Category page placement'
               WHEN 2 THEN 'Featured product slots | Keyword-targeted display ads | Enhanced analytics | Category targeting'
               ELSE 'Banner ads | HVC segment targeting | Cross-sell placements | Dedicated account manager | Priority in watches/health_beauty/computers' END AS ad_package,
       round_even(avg_review_score * 100 * total_orders * CASE WHEN avg_order_value > 535 THEN 1.3::DOUBLE ELSE 1.0::DOUBLE END * 0.1::DOUBLE, 2) AS ad_credit_value
FROM c JOIN r ON c.cluster = r.cluster""")
FIRES = """coalesce({state} IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_4')
            AND {kind} = 'credit_card' AND {value} > 2200, false)"""
TIER_OF_P = "CASE WHEN p >= 0.8 THEN '12+' WHEN p >= 0.65 THEN '7-12' WHEN p >= 0.5 THEN '2-6' ELSE '1' END"
REASON_OF_P = """CASE WHEN p >= 0.8 THEN 'High confidence: proactively surface 12-installment option'
              WHEN p >= 0.65 THEN 'Medium confidence: show 7-12 installment option' WHEN p >= 0.5 THEN 'Low confidence: show basic 2-6 installment option'
              ELSE 'Unlikely to use installments: do not surface installment prompt' END"""
piece("decisions", "profile", f"""
SELECT customer_unique_id, customer_state, total_spend, is_high_value, preferred_payment_type, installment_bucket, avg_order_value,
       CASE WHEN fires THEN greatest(round_even(p, 4), 0.8::DOUBLE) ELSE round_even(p, 4) END AS installment_confidence,
       CASE WHEN fires THEN '12+' ELSE {TIER_OF_P} END AS recommended_tier,
       CASE WHEN fires THEN 'LEAKAGE OVERRIDE: leakage state + credit card + order > HVC threshold' ELSE {REASON_OF_P} END AS recommendation_reason,
       (fires AND p > 0.5) OR p > 0.75 AS final_recommend
FROM (SELECT *, {score('customer_unique_id')} AS p, {FIRES.format(state='customer_state', kind='preferred_payment_type', value='avg_order_value')} AS fires FROM profile)""")
piece("checkouts", "detail profile", f"""
SELECT order_id, total_orders, preferred_payment_type, is_high_value, customer_state, order_value, tier <> '1' AS recommend_installments,
       tier AS recommended_tier, round_even(CASE WHEN fires THEN greatest(p, 0.8::DOUBLE) ELSE p END, 4) AS confidence_score,
       CASE WHEN fires THEN 'LEAKAGE OVERRIDE: ' || customer_state || ' credit card order > R$2200.00. Always surface 12-installment per Module 5 rule layer.'
            ELSE {REASON_OF_P} END AS reason
FROM (SELECT *, CASE WHEN fires THEN '12+' ELSE {TIER_OF_P} END AS tier FROM (
        SELECT d.order_id, coalesce(c.total_orders, 1) AS total_orders, d.payment_type AS preferred_payment_type, coalesce(c.is_high_value, 0) AS is_high_value,
               d.customer_state, d.total_payment_value AS order_value, {score('d.order_id')} AS p,
               {FIRES.format(state='d.customer_state', kind='d.payment_type', value='d.total_payment_value')} AS fires
        FROM detail d LEFT JOIN profile c ON d.customer_unique_id = c.customer_unique_id))""")
ORACLES |= {
    "lead_priorities": with_pieces("priorities", "SELECT * FROM priorities"),
    "lead_priority_profiles": with_pieces("priorities", f"""
SELECT lead_behaviour_profile, count(mql_id) AS count, round_even(avg(days_to_close), 1) AS avg_actual_days,
       round_even({mean('predicted_days_to_close')}, 1) AS avg_predicted_days, round_even({mean('priority_score')}, 1) AS avg_priority_score,
       round_even(avg(CAST(priority_tier = 'HIGH' AS INT)) * 100, 1) AS pct_high_priority FROM priorities GROUP BY 1"""),
    "lead_priority_tiers": with_pieces("priorities", """
SELECT priority_tier, count(*) AS lead_count, round_even(count(*) / sum(count(*)) OVER () * 100, 1) AS pct FROM priorities GROUP BY 1"""),
    "lead_priority_top10": with_pieces("priorities", """
SELECT mql_id, lead_behaviour_profile, business_segment, priority_score, predicted_days_to_close, priority_tier, onboarding_package
FROM priorities ORDER BY priority_score DESC, mql_id LIMIT 10"""),
    "seller_cluster_tiers": with_pieces("cluster_tiers", "SELECT * FROM cluster_tiers"),
    "seller_cluster_centroids": with_pieces("cluster_tiers", f"""
SELECT revenue_tier, count(seller_id) AS count, round_even({mean('total_revenue')}, 1) AS avg_revenue, round_even({mean('avg_review_score')}, 1) AS avg_review_score,
       round_even(avg(total_orders), 1) AS avg_orders, round_even(avg(unique_categories), 1) AS avg_categories,
       round_even(count(seller_id) / sum(count(seller_id)) OVER () * 100, 1) AS pct_sellers, round_even(quantile_cont(total_revenue, 0.5), 1) AS median_revenue
FROM cluster_tiers GROUP BY 1"""),
    "seller_cluster_top10": with_pieces("cluster_tiers", """
SELECT seller_id, seller_state, total_revenue, avg_review_score, revenue_tier, hvc_aligned, ad_credit_value
FROM cluster_tiers ORDER BY total_revenue DESC, seller_id LIMIT 10"""),
    "installment_decisions": with_pieces("decisions", "SELECT * FROM decisions"),
    "installment_decision_tiers": with_pieces("decisions", """
SELECT t AS recommended_tier, count(customer_unique_id) AS customer_count,
       round_even(count(customer_unique_id) / (SELECT count(*) FROM decisions) * 100, 1) AS pct,
       count(*) FILTER (recommendation_reason LIKE 'LEAKAGE%') AS override_count
FROM (SELECT unnest(['12+', '7-12', '2-6', '1']) AS t) LEFT JOIN decisions ON recommended_tier = t GROUP BY t"""),
    "installment_decision_counts": with_pieces("decisions", """
SELECT recommended_tier, final_recommend, count(*) AS customer_count FROM decisions GROUP BY 1, 2"""),
    "checkout_decisions": with_pieces("checkouts", "SELECT * FROM checkouts"),
    "checkout_decision_stream": with_pieces("checkouts", "SELECT * FROM checkouts"),
}

# ---------------------------------------------------------------- sketches, ranks in ranges, refreshed months
ORACLES |= {
    "mart_compaction": ORACLES["mart_versions"],
    "checkout_numbers_stream": with_pieces("detail", """
SELECT customer_unique_id, count(*) AS orders, count(*) AS last_number, count(*) AS numbers
FROM detail WHERE order_purchase_timestamp IS NOT NULL GROUP BY customer_unique_id"""),
    "order_value_quantiles": with_pieces("detail", """
SELECT customer_state, count(total_order_value) AS n, 1 AS q1_within, 1 AS q2_within, 1 AS q3_within FROM detail GROUP BY customer_state"""),
    "seller_breadth": with_pieces("seller_perf", "SELECT seller_id, total_orders, unique_categories FROM seller_perf"),
    "seller_performance_sketched": with_pieces("seller_perf", "SELECT * FROM seller_perf"),
    "customer_ranks": with_pieces("profile", """
SELECT customer_unique_id, total_orders, row_number() OVER (ORDER BY total_orders DESC, customer_unique_id) AS order_rank,
       (rank() OVER (ORDER BY total_orders) + (count(*) OVER (PARTITION BY total_orders) - 1) / 2.0) / count(*) OVER () AS order_percentile
FROM profile"""),
    "refreshed_monthly_revenue": with_pieces("monthly", "SELECT * FROM monthly"),
    "refreshed_price_range": with_pieces("price_range", "SELECT * FROM price_range"),
    "refreshed_mql_monthly": with_pieces("mql_monthly", "SELECT * FROM mql_monthly"),
}

# ---------------------------------------------------------------- comparison of totals and means
# Two engines may differ in the last bit of a division; registry.py rounds these columns of its queries alike.
ROUNDED = {
    name: columns.split()
    for name, columns in {
        "mart_customer_payment_profile": "total_spend avg_order_value avg_installments avg_review_score",
        "mart_order_payment_detail": "total_order_value total_payment_value",
        "mart_geo_payment_summary": "total_revenue avg_order_value credit_card_pct boleto_pct installment_avg high_value_revenue_share",
        "mart_monthly_revenue": "total_revenue avg_order_value",
        "mart_csv_round_trip": "total_revenue avg_order_value",
        "refreshed_monthly_revenue": "total_revenue avg_order_value",
        "refreshed_price_range": "total_revenue avg_price",
        "seller_performance_sketched": "total_revenue avg_order_value avg_review_score",
        "mart_hv_category_preference": "total_spend",
        "mart_seller_performance": "total_revenue avg_order_value avg_review_score",
        "mart_product_price_range": "total_revenue avg_price",
        "mart_review_by_segment": "avg_review_score pct_5star pct_1star avg_delivery_days late_delivery_rate",
        "mart_mql_funnel": "avg_days_to_close",
        "mart_lead_behaviour": "avg_days_to_close avg_declared_revenue",
        "mart_payment_leakage": "avg_value leakage_score",
        "customer_points": "total_spend avg_review_score",
        "seller_points": "total_revenue avg_order_value avg_review_score",
        "leakage_alerts": "avg_value leakage_score",
        "leakage_critical": "avg_value",
        "national_avg_check": "live_avg difference",
        "trigger_segments": "avg_order_value",
        "audience_segments": "total_spend avg_order_value",
        "executive_kpis": "value",
        "seller_cluster_tiers": "total_revenue avg_review_score",
        "seller_cluster_top10": "total_revenue avg_review_score",
        "installment_decisions": "total_spend avg_order_value",
        "checkout_decisions": "order_value",
        "checkout_decision_stream": "order_value",
    }.items()
}
ORACLES |= {name: rounded(ORACLES[name], columns) for name, columns in ROUNDED.items()}
