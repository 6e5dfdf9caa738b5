"""Reference SQL (DuckDB dialect) for every registered query.

Each statement recomputes the same result straight from the driver tables, so the
Spark plan can be checked against an independent engine. Shared steps are CTEs;
``sql(name)`` prepends the CTEs a final SELECT needs, in dependency order.

Cross-engine rules used throughout: money sums are exact sums of doubles, rounded once
(as in the Spark builders); averages are rounded through ``decimal(38,10)``, which gives the
half-up rounding of the value's shortest decimal form that Spark applies to
doubles; DuckDB's day of week is 0-based, Spark's 1-based; text -> int goes
through double and drops the fraction.
"""

from __future__ import annotations

import re

TS = "'%Y-%m-%d %H:%M:%S'"


def _txt(expr: str) -> str:
    return f"strftime({expr}, {TS})"


def _clean(c: str) -> str:
    return f"NULLIF(trim({c}), '')"


def _ts(c: str) -> str:
    return f"TRY_CAST({_clean(c)} AS TIMESTAMP)"


def _int(c: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({c} AS DOUBLE)) AS INTEGER)"


def _dbl(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE)"


def _key(c: str) -> str:
    return f"CAST(strftime({c}, '%Y%m%d') AS INTEGER)"


def _sum(c: str) -> str:
    """The sum of doubles, exact in units of 2**-72 (all test values are such), rounded once: what
    is cut off to leave 62 bits at most sets the last bit, so that it decides ties."""
    total = f"sum(CAST({c} * pow(2::DOUBLE, 72) AS HUGEINT))"
    cases = [f"WHEN abs({total}) < {2 ** 62}::HUGEINT THEN CAST(CAST({total} AS BIGINT) AS DOUBLE)"]
    for cut in range(8, 65, 8):
        kept = f"((abs({total}) >> {cut}) | (CASE WHEN (abs({total}) & {2 ** cut - 1}::HUGEINT) <> 0 THEN 1 ELSE 0 END))"
        limit = min(2 ** (62 + cut), 2 ** 127 - 1)
        cases.append(f"WHEN abs({total}) < {limit}::HUGEINT THEN "
                     f"sign({total}) * CAST(CAST({kept} AS BIGINT) AS DOUBLE) * {2 ** cut}::DOUBLE")
    return f"((CASE {' '.join(cases)} END) / pow(2::DOUBLE, 72))"


def _money(c: str) -> str:
    return f"CAST(CAST(round(CAST(CAST({_sum(c)} AS VARCHAR) AS DECIMAL(38,18)), 2) AS VARCHAR) AS DOUBLE)"


def _avg2(c: str) -> str:
    return f"CAST(round(CAST(avg({c}) AS DECIMAL(38,10)), 2) AS DOUBLE)"


def _round2(expr: str) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), 2) AS DOUBLE)"


def _first(keys: str, order: str) -> str:
    """Keep the first row per key under ``order`` (NULLs first, as in Spark)."""
    cols = ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in order.split(","))
    return f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {cols}) = 1"


def _check_rows(table: str, layer: str, rows: list[tuple[str, str, str, str]], source: str) -> str:
    """One result row per (check_name, value_expr, threshold_expr, rule) over ``source``."""
    parts = []
    for name, value, threshold, rule in rows:
        op = ">" if rule == "gt" else "="
        parts.append(
            f"SELECT '{table}' AS table_name, '{layer}' AS layer, '{name}' AS check_name, "
            f"COALESCE(CAST({value} AS DOUBLE) {op} CAST({threshold} AS DOUBLE), false) AS passed, "
            f"CAST({value} AS DOUBLE) AS value, CAST({threshold} AS DOUBLE) AS threshold "
            f"FROM {source}")
    return "\nUNION ALL\n".join(parts)


CTES: dict[str, str] = {
    # ---- raw sources bound to the driver tables ------------------------------------
    "ship": "SELECT l_orderkey, min(l_shipdate) AS f, max(l_shipdate) AS l "
            "FROM lineitem GROUP BY l_orderkey",
    "raw_orders": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
               {_txt('o_orderdate')} AS order_purchase_timestamp,
               {_txt('o_orderdate')} AS order_approved_at,
               {_txt('ship.f')} AS order_delivered_carrier_date,
               {_txt('ship.l')} AS order_delivered_customer_date,
               {_txt("o_orderdate + INTERVAL 30 DAY")} AS order_estimated_delivery_date
        FROM orders LEFT JOIN ship ON o_orderkey = ship.l_orderkey""",
    "raw_order_items": f"""
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, {_txt('l_shipdate')} AS shipping_limit_date,
               l_extendedprice AS price, l_extendedprice * l_tax AS freight_value
        FROM lineitem""",
    "raw_customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_unique_id,
               lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
               lower(c_mktsegment) AS customer_city, lower(n_name) AS customer_state
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "raw_products": """
        SELECT p_partkey AS product_id, CAST(p_size AS VARCHAR) AS product_category_name,
               p_retailprice AS product_weight_g, CAST(p_size AS DOUBLE) AS product_length_cm,
               CAST(length(p_name) AS DOUBLE) AS product_height_cm,
               CAST(length(p_brand) AS DOUBLE) AS product_width_cm
        FROM part""",
    "raw_category_translation": """
        SELECT CAST(n_nationkey AS VARCHAR) AS product_category_name,
               lower(n_name) AS product_category_name_english
        FROM nation""",
    "raw_sellers": """
        SELECT s_suppkey AS seller_id, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
               s_name AS seller_city, lower(n_name) AS seller_state
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "raw_order_payments": """
        SELECT user_id AS order_id, event_id AS payment_sequential, event_type AS payment_type,
               json_extract_string(props, '$.k') AS payment_installments, value AS payment_value
        FROM events""",
    "raw_order_reviews": f"""
        SELECT o_orderkey AS review_id, o_orderkey AS order_id,
               substr(o_orderpriority, 1, 1) AS review_score,
               CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS review_comment_message,
               {_txt('o_orderdate')} AS review_creation_date,
               {_txt("o_orderdate + INTERVAL 1 DAY")} AS review_answer_timestamp
        FROM orders""",
    "raw_geolocation": """
        SELECT label AS geolocation_zip_code_prefix, CAST(embedding[1] AS DOUBLE) AS geolocation_lat,
               CAST(embedding[2] AS DOUBLE) AS geolocation_lng
        FROM embeddings""",
    # ---- silver --------------------------------------------------------------------
    "typed_orders": f"""
        SELECT order_id, customer_id, {_clean('order_status')} AS order_status,
               {_ts('order_purchase_timestamp')} AS order_purchase_timestamp,
               {_ts('order_approved_at')} AS order_approved_at,
               {_ts('order_delivered_carrier_date')} AS order_delivered_carrier_date,
               {_ts('order_delivered_customer_date')} AS order_delivered_customer_date,
               {_ts('order_estimated_delivery_date')} AS order_estimated_delivery_date
        FROM raw_orders WHERE order_id IS NOT NULL""",
    "s_orders": f"""
        SELECT *, CAST(CAST(order_delivered_customer_date AS DATE)
                       - CAST(order_purchase_timestamp AS DATE) AS INTEGER) AS order_duration_days
        FROM typed_orders
        {_first('order_id', 'customer_id, order_status, order_purchase_timestamp, order_approved_at, order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date')}""",
    "typed_items": f"""
        SELECT order_id, {_int('order_item_id')} AS order_item_id, product_id, seller_id,
               {_ts('shipping_limit_date')} AS shipping_limit_date,
               {_dbl('price')} AS price, {_dbl('freight_value')} AS freight_value
        FROM raw_order_items""",
    "s_order_items": f"""
        SELECT * FROM typed_items
        {_first('order_id, order_item_id', 'product_id, seller_id, shipping_limit_date, price, freight_value')}""",
    "s_customers": f"""
        SELECT * FROM (
          SELECT customer_id, {_clean('customer_unique_id')} AS customer_unique_id,
                 {_clean('customer_zip_code_prefix')} AS customer_zip_code_prefix,
                 {_clean('customer_city')} AS customer_city,
                 upper({_clean('customer_state')}) AS customer_state
          FROM raw_customers) c
        {_first('customer_id', 'customer_unique_id, customer_zip_code_prefix, customer_city, customer_state')}""",
    "names": f"""
        SELECT * FROM (
          SELECT {_clean('product_category_name')} AS product_category_name,
                 {_clean('product_category_name_english')} AS product_category_name_english
          FROM raw_category_translation) t
        {_first('product_category_name', 'product_category_name_english')}""",
    "s_products": f"""
        SELECT * FROM (
          SELECT p.product_id, p.product_category_name, p.product_weight_g, p.product_length_cm,
                 p.product_height_cm, p.product_width_cm,
                 COALESCE(n.product_category_name_english, 'unknown') AS product_category_name_english
          FROM (SELECT product_id, {_clean('product_category_name')} AS product_category_name,
                       product_weight_g, product_length_cm, product_height_cm, product_width_cm
                FROM raw_products) p
          LEFT JOIN names n ON p.product_category_name = n.product_category_name) x
        {_first('product_id', 'product_category_name, product_weight_g, product_length_cm, product_height_cm, product_width_cm, product_category_name_english')}""",
    "s_sellers": f"""
        SELECT * FROM (
          SELECT seller_id, {_clean('seller_zip_code_prefix')} AS seller_zip_code_prefix,
                 {_clean('seller_city')} AS seller_city, upper({_clean('seller_state')}) AS seller_state
          FROM raw_sellers) s
        {_first('seller_id', 'seller_zip_code_prefix, seller_city, seller_state')}""",
    "typed_payments": f"""
        SELECT order_id, {_int('payment_sequential')} AS payment_sequential,
               {_clean('payment_type')} AS payment_type,
               {_int(_clean('payment_installments'))} AS payment_installments,
               {_dbl('payment_value')} AS payment_value
        FROM raw_order_payments""",
    "payment_totals": f"""
        SELECT order_id, {_sum('payment_value')} AS total_payment_value
        FROM typed_payments GROUP BY order_id""",
    "kept_payments": f"""
        SELECT * FROM typed_payments
        {_first('order_id, payment_sequential', 'payment_type, payment_installments, payment_value')}""",
    "s_order_payments": """
        SELECT k.*, t.total_payment_value
        FROM kept_payments k LEFT JOIN payment_totals t ON k.order_id = t.order_id""",
    "s_order_reviews": f"""
        SELECT * FROM (
          SELECT review_id, order_id, {_int(_clean('review_score'))} AS review_score,
                 {_clean('review_comment_message')} AS review_comment_message,
                 {_ts('review_creation_date')} AS review_creation_date,
                 {_ts('review_answer_timestamp')} AS review_answer_timestamp
          FROM raw_order_reviews) r
        {_first('review_id', 'order_id, review_score, review_comment_message, review_creation_date, review_answer_timestamp')}""",
    "s_geolocation": f"""
        SELECT * FROM (
          SELECT geolocation_zip_code_prefix, {_dbl('geolocation_lat')} AS geolocation_lat,
                 {_dbl('geolocation_lng')} AS geolocation_lng
          FROM raw_geolocation) g
        WHERE geolocation_lat BETWEEN -0.2 AND 0.2 AND geolocation_lng BETWEEN -0.2 AND 0.2
        {_first('geolocation_zip_code_prefix', 'geolocation_lat, geolocation_lng')}""",
    # ---- gold ----------------------------------------------------------------------
    "dim_customer": """
        SELECT customer_id, customer_unique_id, customer_city AS city, customer_state AS state,
               customer_zip_code_prefix AS zip_code
        FROM s_customers""",
    "dim_product": """
        SELECT product_id, product_category_name AS category_name,
               product_category_name_english AS category_name_english,
               product_weight_g AS weight_g, product_length_cm AS length_cm,
               product_height_cm AS height_cm, product_width_cm AS width_cm
        FROM s_products""",
    "dim_seller": """
        SELECT seller_id, seller_city AS city, seller_state AS state, seller_zip_code_prefix AS zip_code
        FROM s_sellers""",
    "spine": "SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), "
             "max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS full_date FROM orders",
    "dim_date": """
        SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_id, full_date,
               CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
               CAST(month(full_date) AS INTEGER) AS month, CAST(day(full_date) AS INTEGER) AS day,
               CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week,
               dayofweek(full_date) IN (0, 6) AS is_weekend
        FROM spine""",
    "dim_payment_type": """
        SELECT CAST(row_number() OVER (ORDER BY payment_type) AS INTEGER) AS payment_type_id, payment_type
        FROM (SELECT DISTINCT payment_type FROM s_order_payments WHERE payment_type IS NOT NULL) p""",
    "per_order": f"""
        SELECT order_id, count(*) AS total_items,
               {_sum('price')} AS total_revenue, {_sum('freight_value')} AS freight_total
        FROM s_order_items GROUP BY order_id""",
    "fact_orders": f"""
        SELECT o.order_id, o.customer_id, o.order_status,
               {_key('o.order_purchase_timestamp')} AS purchase_date_id,
               {_key('o.order_delivered_customer_date')} AS delivered_date_id,
               CAST(COALESCE(p.total_items, 0) AS BIGINT) AS total_items,
               COALESCE(p.total_revenue, CAST(0 AS DOUBLE)) AS total_revenue,
               COALESCE(p.freight_total, CAST(0 AS DOUBLE)) AS freight_total,
               o.order_duration_days,
               CAST(CAST(o.order_delivered_customer_date AS DATE)
                    - CAST(o.order_purchase_timestamp AS DATE) AS INTEGER) AS delivery_days,
               o.order_delivered_customer_date > o.order_estimated_delivery_date AS is_late_delivery
        FROM s_orders o LEFT JOIN per_order p ON o.order_id = p.order_id""",
    "fact_order_items": """
        SELECT order_id, order_item_id, product_id, seller_id, price, freight_value,
               CAST(1 AS INTEGER) AS quantity
        FROM s_order_items""",
    "fact_reviews": f"""
        SELECT review_id, order_id, {_key('review_creation_date')} AS review_date_id, review_score,
               review_comment_message IS NOT NULL AS has_comment
        FROM s_order_reviews""",
    "fact_payments": """
        SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value
        FROM s_order_payments""",
}

# Final statements; names in FROM/JOIN refer to CTEs above or driver tables.
FINAL: dict[str, str] = {
    "silver_orders": "SELECT *, 'olist_orders_dataset.csv' AS _source_file FROM s_orders",
    "silver_order_items": "SELECT *, 'olist_order_items_dataset.csv' AS _source_file FROM s_order_items",
    "silver_customers": "SELECT *, 'olist_customers_dataset.csv' AS _source_file FROM s_customers",
    "silver_products": "SELECT *, 'olist_products_dataset.csv' AS _source_file FROM s_products",
    "silver_sellers": "SELECT *, 'olist_sellers_dataset.csv' AS _source_file FROM s_sellers",
    "silver_order_payments": "SELECT *, 'olist_order_payments_dataset.csv' AS _source_file "
                             "FROM s_order_payments",
    "silver_order_reviews": "SELECT *, 'olist_order_reviews_dataset.csv' AS _source_file "
                            "FROM s_order_reviews",
    "silver_geolocation": "SELECT *, 'olist_geolocation_dataset.csv' AS _source_file FROM s_geolocation",
    "dim_customer": "SELECT * FROM dim_customer",
    "dim_product": "SELECT * FROM dim_product",
    "dim_seller": "SELECT * FROM dim_seller",
    "dim_date_order_days": """
        SELECT d.*, CAST(COALESCE(p.orders, 0) AS BIGINT) AS orders
        FROM dim_date d LEFT JOIN (SELECT purchase_date_id AS date_id, count(*) AS orders
                                   FROM fact_orders GROUP BY purchase_date_id) p
          ON d.date_id = p.date_id""",
    "dim_payment_type": "SELECT * FROM dim_payment_type",
    "fact_orders": "SELECT * FROM fact_orders",
    "fact_order_items": "SELECT * FROM fact_order_items",
    "fact_reviews": "SELECT * FROM fact_reviews",
    "fact_payments": "SELECT * FROM fact_payments",
    "dim_date_covering_orders": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS full_date,
               CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
               CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT CAST(min(order_purchase_timestamp) AS DATE) AS lo,
                           CAST(max(order_purchase_timestamp) AS DATE) AS hi FROM s_orders) b) x""",
    "mart_monthly_revenue": f"""
        SELECT d.year, d.month, {_money('f.total_revenue')} AS revenue,
               count(DISTINCT f.order_id) AS order_count
        FROM fact_orders f JOIN dim_date d ON f.purchase_date_id = d.date_id
        GROUP BY d.year, d.month""",
    "mart_state_performance": f"""
        SELECT c.state, count(DISTINCT f.order_id) AS order_count,
               {_money('f.total_revenue')} AS revenue, {_avg2('f.delivery_days')} AS avg_delivery_days
        FROM fact_orders f JOIN dim_customer c ON f.customer_id = c.customer_id
        GROUP BY c.state""",
    "mart_category_ranking": f"""
        SELECT p.category_name_english, {_money('i.price')} AS revenue, count(*) AS items_sold
        FROM fact_order_items i JOIN dim_product p ON i.product_id = p.product_id
        GROUP BY p.category_name_english""",
    "mart_delivery_kpi": f"""
        SELECT count(*) AS total_orders, {_avg2('delivery_days')} AS avg_delivery_days,
               {_round2('sum(CAST(is_late_delivery AS INTEGER)) / count(*) * 100')}
                 AS late_delivery_rate_pct
        FROM fact_orders""",
    "mart_review_by_category": f"""
        SELECT p.category_name_english, {_avg2('r.review_score')} AS avg_review_score,
               count(*) AS review_count
        FROM fact_reviews r JOIN fact_order_items i ON r.order_id = i.order_id
             JOIN dim_product p ON i.product_id = p.product_id
        GROUP BY p.category_name_english""",
    "mart_payment_distribution": f"""
        SELECT payment_type, count(*) AS payment_count, {_money('payment_value')} AS total_value
        FROM fact_payments GROUP BY payment_type""",
    "mart_customer_retention": f"""
        SELECT count(*) AS total_customers,
               CAST(sum(CASE WHEN order_count >= 2 THEN 1 ELSE 0 END) AS BIGINT) AS repeat_customers,
               {_round2('sum(CASE WHEN order_count >= 2 THEN 1 ELSE 0 END) / count(*) * 100')}
                 AS retention_rate_pct
        FROM (SELECT c.customer_unique_id, count(DISTINCT f.order_id) AS order_count
              FROM fact_orders f JOIN dim_customer c ON f.customer_id = c.customer_id
              GROUP BY c.customer_unique_id) per_person""",
    "clean_padded_segments": """
        SELECT c_custkey,
               upper(NULLIF(trim(CASE WHEN c_custkey % 10 = 0 THEN '   '
                                      ELSE '  ' || lower(c_mktsegment) || ' ' END), '')) AS segment
        FROM customer""",
    "orphan_documents_without_labels": """
        SELECT CAST(count(*) AS BIGINT) AS orphans FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "events_with_user_total": f"""
        SELECT e.event_id, e.user_id, e.value, t.user_total
        FROM events e LEFT JOIN (SELECT user_id, {_money('value')} AS user_total
                                 FROM events GROUP BY user_id) t ON e.user_id = t.user_id""",
    "csv_roundtrip_orders": """
        SELECT count(*) AS csv_records, CAST(sum(order_id) AS BIGINT) AS key_sum,
               count(order_delivered_customer_date) AS delivered
        FROM raw_orders""",
    "jdbc_seeded_bronze_orders": """
        SELECT count(*) AS rows, CAST(sum(order_id) AS BIGINT) AS key_sum,
               count(order_delivered_customer_date) AS delivered, CAST(1 AS BIGINT) AS source_files
        FROM raw_orders""",
    "jdbc_roundtrip_customer": """
        SELECT n_name, count(*) AS customers,
               CAST(round(sum(CAST(c_acctbal AS DECIMAL(18,2))), 2) AS DOUBLE) AS acctbal_total
        FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
    "partitioned_events_roundtrip": """
        SELECT CAST(ts AS DATE) AS event_date, count(*) AS events FROM events GROUP BY 1""",
    "streamed_bronze_orders": """
        SELECT count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, count(*) AS audited,
               count(*) AS rows_first_run, CAST(0 AS BIGINT) AS rows_second_run
        FROM orders""",
    "csv_reconciled_bronze_orders": """
        SELECT 'bronze.orders' AS table_name, 'bronze' AS layer,
               'rowcount_matches_csv' AS check_name, true AS passed,
               CAST(count(*) AS DOUBLE) AS value, CAST(count(*) AS DOUBLE) AS threshold
        FROM orders""",
    "csv_reconciliation_lost_rows": """
        SELECT 'bronze.orders' AS table_name, 'bronze' AS layer,
               'rowcount_matches_csv' AS check_name, false AS passed,
               CAST(count(*) FILTER (WHERE o_custkey % 50 <> 1) AS DOUBLE) AS value,
               CAST(count(*) AS DOUBLE) AS threshold
        FROM orders""",
    "listed_tables": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}"
        for t in ("customer", "nation", "orders", "supplier")),
    "sized_session": """
        SELECT fact, true AS holds, customers, lines
        FROM (VALUES ('a reducer gets its bytes or less'), ('two waves of tasks or more'),
                     ('no more than the input asks for'), ('splits are as large as asked'),
                     ('settings are in force')) AS f(fact),
             (SELECT count(DISTINCT o_custkey) AS customers, count(*) AS lines
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey) j""",
    "results_stored_once_a_run": """
        SELECT 'group ' || (user_id % 3) AS run_id, count(*) AS rows,
               CAST(sum(event_id) AS BIGINT) AS key_sum,
               CAST((SELECT 2 * count(*) + count(*) FILTER (WHERE user_id % 3 = 1) FROM events) AS BIGINT)
                 AS rows_written
        FROM events WHERE user_id IS NOT NULL GROUP BY 1""",
    "csv_documents_in_splits": """
        SELECT count(*) AS csv_records, CAST(sum(doc_id) AS BIGINT) AS key_sum,
          CAST(sum(CAST('0x' || substr(md5('"' || text || '",' || chr(10) || source), 1, 8) AS BIGINT)) AS BIGINT)
            AS text_digest, true AS many_tasks
        FROM documents""",
    "csv_columns_by_name": """
        SELECT order_id, customer_id, order_status, order_purchase_timestamp,
               upper(order_status) AS note
        FROM raw_orders""",
    "orders_outside_calendar": """
        SELECT CAST(count(*) AS BIGINT) AS orphans FROM fact_orders
        WHERE purchase_date_id IS NULL OR purchase_date_id NOT BETWEEN 19960201 AND 19980630""",
    "months_of_a_short_calendar": f"""
        SELECT CAST(purchase_date_id // 10000 AS INTEGER) AS year,
               CAST(purchase_date_id // 100 % 100 AS INTEGER) AS month,
               {_money('total_revenue')} AS revenue, count(DISTINCT order_id) AS order_count
        FROM fact_orders WHERE purchase_date_id BETWEEN 19960201 AND 19980630 GROUP BY 1, 2""",
    "days_of_a_short_calendar": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS full_date,
               CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
               CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend,
               CAST(COALESCE(orders, 0) AS BIGINT) AS orders
        FROM (SELECT CAST(unnest(generate_series(DATE '1996-02-01', DATE '1998-06-30', INTERVAL 1 DAY))
                          AS DATE) AS d) x
        LEFT JOIN (SELECT purchase_date_id, count(*) AS orders FROM fact_orders GROUP BY 1) p
          ON purchase_date_id = CAST(strftime(d, '%Y%m%d') AS INTEGER)""",
    "orders_by_month_and_year": """
        SELECT CAST(CASE WHEN grouping(month) = 0 THEN 0 ELSE 1 END AS INTEGER) AS level, year, month,
               count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS customers
        FROM (SELECT CAST(purchase_date_id // 10000 AS INTEGER) AS year,
                     CAST(purchase_date_id // 100 % 100 AS INTEGER) AS month, order_id, customer_id
              FROM fact_orders WHERE purchase_date_id IS NOT NULL) f
        GROUP BY GROUPING SETS ((year, month), (year))""",
    "unique_line_keys": "\nUNION ALL\n".join(
        _check_rows(t, "raw", [(f"unique_{'_'.join(keys)}", "COALESCE(sum(n - 1), 0)", "0", "eq")],
                    f"(SELECT count(*) AS n FROM {t} GROUP BY {', '.join(keys)}) k")
        for t, keys in [
            ("lineitem", ["l_orderkey", "l_linenumber"]),
            ("lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                          "l_extendedprice"]),
            ("lineitem", ["l_partkey", "l_returnflag", "l_shipdate"]),
            ("documents", ["text"]), ("documents", ["source", "text"])]),
    "money_sums_of_odd_values": f"""
        SELECT part_group, count(*) AS items,
               CASE WHEN part_group IN (1, 2, 3, 4) THEN sum(price)
                    ELSE {_sum('CASE WHEN part_group NOT IN (1, 2, 3, 4) THEN price END')} END AS total
        FROM (SELECT l_partkey % 40 AS part_group,
                CASE WHEN l_partkey % 40 = 1 AND l_linenumber = 1 THEN CAST('NaN' AS DOUBLE)
                     WHEN l_partkey % 40 = 2 AND l_linenumber = 1 THEN CAST('Infinity' AS DOUBLE)
                     WHEN l_partkey % 40 = 3 THEN CAST(1e15 AS DOUBLE)
                     WHEN l_partkey % 40 = 4 AND l_linenumber = 1 THEN pow(CAST(2 AS DOUBLE), 84)
                     WHEN l_partkey % 40 = 5 THEN CAST(0.00005 AS DOUBLE)
                     ELSE l_extendedprice END AS price
              FROM lineitem) i
        GROUP BY part_group""",
    "months_in_order": f"""
        SELECT *, row_number() OVER (ORDER BY year, month) AS place FROM (
          SELECT d.year, d.month, {_money('f.total_revenue')} AS revenue,
                 count(DISTINCT f.order_id) AS order_count
          FROM fact_orders f JOIN dim_date d ON f.purchase_date_id = d.date_id
          GROUP BY d.year, d.month) m""",
    "categories_in_order": f"""
        SELECT *, row_number() OVER (ORDER BY revenue DESC, category_name_english) AS place FROM (
          SELECT p.category_name_english, {_money('i.price')} AS revenue, count(*) AS items_sold
          FROM fact_order_items i JOIN dim_product p ON i.product_id = p.product_id
          GROUP BY p.category_name_english) m""",
    "integers_of_odd_text": """
        SELECT o_orderkey, CAST([5, 5, 12, -3, 8, NULL, NULL, NULL, NULL, NULL, 0, 7]
                                [o_orderkey % 12 + 1] AS INTEGER) AS n
        FROM orders""",
    "refreshed_orders_table": """
        SELECT 'olist_orders_dataset.csv' AS _source_file, count(*) AS table_rows,
               2 * count(*) AS log_rows, count(*) AS rows_written, 2 * count(*) AS rows_appended
        FROM orders""",
}


def _count_if(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


_BRONZE_KEYS = {
    "orders": ["order_id"], "order_items": ["order_id", "order_item_id"],
    "customers": ["customer_id"], "products": ["product_id"], "sellers": ["seller_id"],
    "order_payments": ["order_id", "payment_sequential"], "order_reviews": ["review_id"],
    "geolocation": ["geolocation_zip_code_prefix"],
    "category_translation": ["product_category_name"],
}


def _bronze_suite() -> str:
    parts = []
    for t, keys in _BRONZE_KEYS.items():
        rows = [("row_count_gt_0", "count(*)", "0", "gt")] + [
            (f"{k}_not_null", _count_if(f"{k} IS NULL"), "0", "eq") for k in keys]
        parts.append(_check_rows(f"bronze.{t}", "bronze", rows, f"raw_{t}"))
    return "\nUNION ALL\n".join(parts)


def _silver_suite(low: str = "2016-01-01", high: str = "2019-12-31") -> str:
    bad_ts = (f"order_purchase_timestamp < TIMESTAMP '{low} 00:00:00' OR "
              f"order_purchase_timestamp > TIMESTAMP '{high} 00:00:00'")
    return "\nUNION ALL\n".join([
        _check_rows("silver.orders", "silver", [
            ("order_id_not_null", _count_if("order_id IS NULL"), "0", "eq"),
            ("purchase_ts_in_range", _count_if(bad_ts), "0", "eq")], "s_orders"),
        _check_rows("silver.orders", "silver", [
            ("unique_order_id", "sum(n - 1)", "0", "eq")],
            "(SELECT count(*) AS n FROM s_orders GROUP BY order_id) g"),
        _check_rows("silver.order_items", "silver", [
            ("price_positive", _count_if("price <= 0"), "0", "eq")], "s_order_items"),
        _check_rows("silver.order_items", "silver", [
            ("unique_order_id_order_item_id", "sum(n - 1)", "0", "eq")],
            "(SELECT count(*) AS n FROM s_order_items GROUP BY order_id, order_item_id) g"),
        _check_rows("silver.order_reviews", "silver", [
            ("review_score_between_1_5", _count_if("review_score < 1 OR review_score > 5"), "0", "eq")],
            "s_order_reviews"),
    ])


def _orphans(child: str, ck: str, parent: str, pk: str) -> str:
    return (f"(SELECT count(*) AS n FROM {child} c WHERE NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{pk} = c.{ck})) o")


def _gold_suite() -> str:
    return "\nUNION ALL\n".join([
        _check_rows("gold.fact_order_items", "gold", [("fk_order_id_in_order_id", "n", "0", "eq")],
                    _orphans("fact_order_items", "order_id", "fact_orders", "order_id")),
        _check_rows("gold.fact_order_items", "gold", [("fk_product_id_in_product_id", "n", "0", "eq")],
                    _orphans("fact_order_items", "product_id", "dim_product", "product_id")),
        _check_rows("gold.fact_order_items", "gold", [("fk_seller_id_in_seller_id", "n", "0", "eq")],
                    _orphans("fact_order_items", "seller_id", "dim_seller", "seller_id")),
        _check_rows("gold.fact_orders", "gold", [("fk_customer_id_in_customer_id", "n", "0", "eq")],
                    _orphans("fact_orders", "customer_id", "dim_customer", "customer_id")),
        _check_rows("gold.fact_orders", "gold", [("rowcount_matches_silver_orders", "a", "b", "eq")],
                    "(SELECT (SELECT count(*) FROM fact_orders) AS a, "
                    "(SELECT count(*) FROM s_orders) AS b) c"),
        _check_rows("gold.dim_customer", "gold", [
            ("customer_id_not_null", _count_if("customer_id IS NULL"), "0", "eq")], "dim_customer"),
        _check_rows("gold.dim_product", "gold", [
            ("product_id_not_null", _count_if("product_id IS NULL"), "0", "eq")], "dim_product"),
    ])


FINAL["dq_bronze_suite"] = _bronze_suite()
FINAL["dq_silver_suite"] = _silver_suite()
FINAL["dq_gold_suite"] = _gold_suite()


def _acceptance_suite() -> str:
    return "\nUNION ALL\n".join([
        _check_rows("silver.orders", "tests", [
            ("order_id_not_null", _count_if("order_id IS NULL"), "0", "eq")], "s_orders"),
        _check_rows("silver.orders", "tests", [("unique_order_id", "sum(n - 1)", "0", "eq")],
                    "(SELECT count(*) AS n FROM s_orders GROUP BY order_id) g"),
        _check_rows("silver.order_items", "tests", [
            ("unique_order_id_order_item_id", "sum(n - 1)", "0", "eq")],
            "(SELECT count(*) AS n FROM s_order_items GROUP BY order_id, order_item_id) g"),
        _check_rows("silver.order_reviews", "tests", [
            ("review_score_between_1_5", _count_if("review_score < 1 OR review_score > 5"), "0", "eq")],
            "s_order_reviews"),
        _check_rows("gold.fact_order_items", "tests", [("fk_order_id_in_order_id", "n", "0", "eq")],
                    _orphans("fact_order_items", "order_id", "fact_orders", "order_id")),
        _check_rows("gold.fact_orders", "tests", [
            ("total_revenue_non_negative", _count_if("total_revenue < 0"), "0", "eq")], "fact_orders"),
        _check_rows("gold.fact_orders", "tests", [("rowcount_matches_silver_orders", "a", "b", "eq")],
                    "(SELECT (SELECT count(*) FROM fact_orders) AS a, "
                    "(SELECT count(*) FROM s_orders) AS b) c"),
        _check_rows("gold.dim_customer", "tests", [
            ("customer_id_not_null", _count_if("customer_id IS NULL"), "0", "eq")], "dim_customer"),
    ])


FINAL["dq_acceptance_suite"] = _acceptance_suite()
FINAL["gated_refresh_results"] = "\nUNION ALL\n".join([
    _bronze_suite(), _silver_suite("1990-01-01", "2010-12-31"), _gold_suite(),
    _acceptance_suite()])


def _deps(text: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", text))
    return [n for n in CTES if n in words]


def sql(name: str) -> str:
    """The full statement for ``name``: needed CTEs (dependencies first) + final SELECT."""
    final = FINAL[name]
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for d in _deps(CTES[n]):
            if d != n:
                visit(d)
        ordered.append(n)

    for d in _deps(final):
        visit(d)
    if not ordered:
        return final.strip()
    ctes = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in ordered)
    return f"WITH {ctes}\n{final.strip()}"


def oracle_sql() -> dict[str, str]:
    return {name: sql(name) for name in FINAL}
