"""The registered queries in plain SQL over the given tables, as DuckDB runs it.

Written from the rules, not from the Spark code. ``VIEWS`` build on each other
and are put in front of a query as far as it needs them.
"""

from __future__ import annotations

import re

from verification.derive import EPOCH, SHAPES_SQL, SOURCE_SQL

# Keyed tables whose log ends with a delete for these row numbers.
_DELETED = "_n % 50 <> 7"

VIEWS: dict[str, str] = {f"src_{table}": text for table, text in SOURCE_SQL.items()}

VIEWS["event_log"] = f"""
SELECT event_id AS kafka_offset, CAST(user_id % 4 AS INTEGER) AS kafka_partition,
       CAST(user_id AS VARCHAR) AS k,
       CASE WHEN event_type = 'error' THEN NULL
            ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS v,
       CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
       {EPOCH} + (event_id // 2) * 1000 AS ts_ms, event_type
FROM events"""

# --- silver ----------------------------------------------------------------

VIEWS["silver_customers"] = f"""
SELECT trim(customer_id) AS customer_id, trim(customer_unique_id) AS customer_unique_id,
       trim(customer_zip_code_prefix) AS customer_zip_code_prefix,
       upper(trim(customer_city)) AS customer_city, upper(trim(customer_state)) AS customer_state
FROM src_customers WHERE {_DELETED}"""

VIEWS["silver_geolocation"] = """
SELECT geolocation_zip_code_prefix AS zip_code_prefix, upper(trim(geolocation_city)) AS city,
       upper(trim(geolocation_state)) AS state,
       round(avg(geolocation_lat), 6) AS avg_latitude,
       round(avg(geolocation_lng), 6) AS avg_longitude
FROM src_geolocation
WHERE geolocation_lat BETWEEN -90 AND 90 AND geolocation_lng BETWEEN -180 AND 180
  AND _n % 50 <> 7
GROUP BY ALL"""

VIEWS["silver_sellers"] = f"""
SELECT seller_id, seller_zip_code_prefix, upper(trim(seller_city)) AS seller_city,
       upper(trim(seller_state)) AS seller_state
FROM src_sellers WHERE {_DELETED}"""

VIEWS["silver_category_translation"] = """
SELECT product_category_name, product_category_name_english FROM src_category_translation"""

VIEWS["silver_products"] = f"""
SELECT product_id, product_category_name, CAST(product_name_length AS INTEGER) AS product_name_length,
       product_description_length, CAST(product_photos_qty AS INTEGER) AS product_photos_qty,
       product_weight_g, product_length_cm, CAST(product_height_cm AS INTEGER) AS product_height_cm,
       product_width_cm,
       CAST(product_length_cm AS BIGINT) * product_height_cm * product_width_cm
         AS product_volume_cm3
FROM src_products WHERE {_DELETED}"""

VIEWS["silver_orders"] = f"""
SELECT order_id, customer_id, upper(trim(order_status)) AS order_status,
       order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
       order_delivered_customer_date, order_estimated_delivery_date,
       CAST(year(order_purchase_timestamp) AS INTEGER) AS order_year,
       CAST(month(order_purchase_timestamp) AS INTEGER) AS order_month,
       CAST(day(order_purchase_timestamp) AS INTEGER) AS order_day,
       CAST(hour(order_purchase_timestamp) AS INTEGER) AS order_hour,
       CAST(CAST(order_approved_at AS DATE) - CAST(order_purchase_timestamp AS DATE) AS INTEGER)
         AS approval_delay_days,
       CAST(CAST(order_delivered_customer_date AS DATE) - CAST(order_purchase_timestamp AS DATE) AS INTEGER)
         AS actual_delivery_days,
       CAST(CAST(order_estimated_delivery_date AS DATE) - CAST(order_purchase_timestamp AS DATE) AS INTEGER)
         AS estimated_delivery_days,
       CAST(CAST(order_delivered_customer_date AS DATE) - CAST(order_estimated_delivery_date AS DATE) AS INTEGER)
         AS delivery_delay_days,
       CASE WHEN delivery_delay_days > 0 THEN TRUE WHEN delivery_delay_days <= 0 THEN FALSE END
         AS is_delivered_late,
       upper(trim(order_status)) = 'DELIVERED' AS is_delivered
FROM src_orders WHERE {_DELETED}"""

# Money in whole cents; the first of each key by shipping date, then offset, newest first.
VIEWS["silver_order_items"] = """
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
       CAST(round(price * 100) AS BIGINT) AS price_c,
       CAST(round(freight_value * 100) AS BIGINT) AS freight_c,
       CAST(round(price * 100) AS BIGINT) + CAST(round(freight_value * 100) AS BIGINT) AS total_c
FROM src_order_items
QUALIFY row_number() OVER (
  PARTITION BY order_id, order_item_id ORDER BY shipping_limit_date DESC, _n % 4 DESC, _n DESC) = 1"""

VIEWS["silver_payments"] = f"""
SELECT order_id, payment_sequential, upper(trim(payment_type)) AS payment_type,
       CAST(payment_installments AS INTEGER) AS payment_installments,
       CAST(round(payment_value * 100) AS BIGINT) AS value_c
FROM src_order_payments WHERE {_DELETED}"""

VIEWS["silver_reviews"] = f"""
SELECT review_id, order_id, CAST(review_score AS INTEGER) AS review_score,
       trim(review_comment_title) AS review_comment_title,
       trim(review_comment_message) AS review_comment_message,
       review_creation_date, review_answer_timestamp,
       CASE WHEN review_score >= 4 THEN 'POSITIVE' WHEN review_score = 3 THEN 'NEUTRAL'
            WHEN review_score <= 2 THEN 'NEGATIVE' ELSE 'UNKNOWN' END AS review_rating,
       coalesce(trim(review_comment_title), '') <> ''
         OR coalesce(trim(review_comment_message), '') <> '' AS has_comment,
       date_diff('minute', review_creation_date, review_answer_timestamp) AS answer_minutes
FROM src_order_reviews WHERE {_DELETED}"""

# --- gold ------------------------------------------------------------------

VIEWS["dim_geography"] = """
WITH one_place AS (
  SELECT * FROM silver_geolocation
  QUALIFY row_number() OVER (
    PARTITION BY zip_code_prefix ORDER BY avg_latitude, avg_longitude, city, state) = 1)
SELECT row_number() OVER (ORDER BY zip_code_prefix) AS geography_sk, zip_code_prefix, city, state,
       CASE WHEN state IN ('SP','RJ','MG','ES') THEN 'SUDESTE'
            WHEN state IN ('PR','SC','RS') THEN 'SUL'
            WHEN state IN ('MT','MS','GO','DF') THEN 'CENTRO-OESTE'
            WHEN state IN ('BA','SE','AL','PE','PB','RN','CE','PI','MA') THEN 'NORDESTE'
            WHEN state IN ('AM','PA','AC','RO','RR','AP','TO') THEN 'NORTE'
            ELSE 'OUTROS' END AS region,
       avg_latitude AS latitude, avg_longitude AS longitude
FROM one_place
UNION ALL SELECT -1, '00000', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', NULL, NULL"""

VIEWS["dim_date"] = """
WITH bounds AS (
  SELECT min(y) AS y0, max(y) AS y1 FROM (
    SELECT year(order_purchase_timestamp) AS y FROM silver_orders
    UNION ALL SELECT year(review_creation_date) FROM silver_reviews)),
days AS (
  SELECT CAST(unnest(generate_series(make_date(y0, 1, 1), make_date(y1, 12, 31),
                                     INTERVAL 1 DAY)) AS DATE) AS d FROM bounds)
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, d AS full_date,
       CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
       dayname(d) AS day_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
       CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
       dayofweek(d) IN (0, 6) AS is_weekend,
       strftime(d, '%Y-%m') AS year_month,
       concat(year(d), '-Q', quarter(d)) AS year_quarter
FROM days
UNION ALL
SELECT -1, NULL, NULL, NULL, 'UNKNOWN', NULL, NULL, 'UNKNOWN', NULL, NULL, NULL, 'UNKNOWN', 'UNKNOWN'"""

VIEWS["dim_customer"] = """
WITH people AS (
  SELECT * FROM silver_customers
  QUALIFY row_number() OVER (PARTITION BY customer_unique_id ORDER BY customer_id) = 1)
SELECT row_number() OVER (ORDER BY customer_unique_id) AS customer_sk, customer_unique_id,
       customer_zip_code_prefix, customer_city, customer_state
FROM people
UNION ALL SELECT -1, 'UNKNOWN', '00000', 'UNKNOWN', 'UNKNOWN'"""

VIEWS["dim_seller"] = """
SELECT row_number() OVER (ORDER BY seller_id) AS seller_sk, seller_id, seller_zip_code_prefix,
       seller_city, seller_state
FROM silver_sellers
UNION ALL SELECT -1, 'UNKNOWN', '00000', 'UNKNOWN', 'UNKNOWN'"""

VIEWS["dim_product"] = """
SELECT row_number() OVER (ORDER BY product_id) AS product_sk, product_id, product_category_name,
       coalesce(product_category_name_english, product_category_name)
         AS product_category_name_english,
       product_name_length, product_description_length, product_photos_qty, product_weight_g,
       product_length_cm, product_height_cm, product_width_cm, product_volume_cm3,
       CASE WHEN product_volume_cm3 IS NULL THEN 'UNKNOWN' WHEN product_volume_cm3 < 1000 THEN 'SMALL'
            WHEN product_volume_cm3 < 10000 THEN 'MEDIUM' WHEN product_volume_cm3 < 50000 THEN 'LARGE'
            ELSE 'EXTRA_LARGE' END AS size_category,
       CASE WHEN product_weight_g IS NULL THEN 'UNKNOWN' WHEN product_weight_g < 500 THEN 'LIGHT'
            WHEN product_weight_g < 2000 THEN 'MEDIUM' WHEN product_weight_g < 10000 THEN 'HEAVY'
            ELSE 'VERY_HEAVY' END AS weight_category
FROM silver_products LEFT JOIN silver_category_translation USING (product_category_name)
UNION ALL
SELECT -1, 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       'UNKNOWN', 'UNKNOWN'"""

VIEWS["dim_order_status"] = """
WITH known (order_status, status_description, status_category, terminal, position) AS (VALUES
  ('CREATED', 'Order created', 'PENDING', FALSE, 1),
  ('APPROVED', 'Payment approved', 'IN_PROGRESS', FALSE, 2),
  ('PROCESSING', 'Order is being processed', 'IN_PROGRESS', FALSE, 3),
  ('INVOICED', 'Invoice generated', 'IN_PROGRESS', FALSE, 4),
  ('SHIPPED', 'Order shipped and in transit', 'IN_PROGRESS', FALSE, 5),
  ('DELIVERED', 'Order successfully delivered to customer', 'COMPLETED', TRUE, 6),
  ('UNAVAILABLE', 'Product unavailable', 'FAILED', TRUE, 98),
  ('CANCELED', 'Order was canceled', 'FAILED', TRUE, 99))
SELECT row_number() OVER (ORDER BY s.order_status) AS order_status_sk, s.order_status,
       coalesce(status_description, 'Unknown status') AS status_description,
       coalesce(status_category, 'OTHER') AS status_category,
       coalesce(terminal, FALSE) AS is_terminal_state,
       s.order_status = 'DELIVERED' AS is_successful, coalesce(position, 0) AS pipeline_order
FROM (SELECT DISTINCT order_status FROM silver_orders) s LEFT JOIN known USING (order_status)
UNION ALL SELECT -1, 'UNKNOWN', 'Unknown order status', 'OTHER', FALSE, FALSE, 0"""

VIEWS["fact_items"] = """
SELECT i.order_id, i.order_item_id,
       coalesce(CAST(strftime(o.order_purchase_timestamp, '%Y%m%d') AS INTEGER), -1) AS date_sk,
       coalesce(dc.customer_sk, -1) AS customer_sk, coalesce(dp.product_sk, -1) AS product_sk,
       coalesce(ds.seller_sk, -1) AS seller_sk, coalesce(st.order_status_sk, -1) AS order_status_sk,
       coalesce(gc.geography_sk, -1) AS customer_geography_sk,
       coalesce(gs.geography_sk, -1) AS seller_geography_sk,
       i.price_c, i.freight_c, i.total_c, o.actual_delivery_days, o.delivery_delay_days,
       o.is_delivered, o.is_delivered_late, o.order_purchase_timestamp, o.order_approved_at,
       o.order_delivered_customer_date, i.shipping_limit_date
FROM silver_order_items i
JOIN silver_orders o USING (order_id)
LEFT JOIN silver_customers c USING (customer_id)
LEFT JOIN dim_customer dc ON dc.customer_unique_id = c.customer_unique_id
LEFT JOIN dim_seller ds ON ds.seller_id = i.seller_id
LEFT JOIN dim_product dp ON dp.product_id = i.product_id
LEFT JOIN dim_order_status st ON st.order_status = o.order_status
LEFT JOIN dim_geography gc ON gc.zip_code_prefix = c.customer_zip_code_prefix
  AND gc.geography_sk <> -1
LEFT JOIN dim_geography gs ON gs.zip_code_prefix = ds.seller_zip_code_prefix
  AND gs.geography_sk <> -1"""

VIEWS["fact_reviews"] = """
SELECT r.review_id, r.order_id,
       coalesce(CAST(strftime(r.review_creation_date, '%Y%m%d') AS INTEGER), -1) AS review_date_sk,
       coalesce(CAST(strftime(o.order_purchase_timestamp, '%Y%m%d') AS INTEGER), -1) AS order_date_sk,
       coalesce(dc.customer_sk, -1) AS customer_sk, coalesce(dp.product_sk, -1) AS product_sk,
       coalesce(g.geography_sk, -1) AS customer_geography_sk,
       r.review_score, r.review_rating, r.has_comment, r.review_comment_title,
       r.review_comment_message, r.answer_minutes,
       CASE WHEN review_score >= 4 THEN 1 ELSE 0 END AS is_positive,
       CASE WHEN review_score = 3 THEN 1 ELSE 0 END AS is_neutral,
       CASE WHEN review_score <= 2 THEN 1 ELSE 0 END AS is_negative,
       CASE WHEN has_comment THEN 1 ELSE 0 END AS has_comment_flag,
       r.review_creation_date, r.review_answer_timestamp
FROM silver_reviews r
JOIN silver_orders o USING (order_id)
LEFT JOIN silver_customers c USING (customer_id)
JOIN silver_order_items i USING (order_id)
LEFT JOIN dim_customer dc ON dc.customer_unique_id = c.customer_unique_id
LEFT JOIN dim_product dp ON dp.product_id = i.product_id
LEFT JOIN dim_geography g ON g.zip_code_prefix = c.customer_zip_code_prefix
  AND g.geography_sk <> -1"""

VIEWS["revenue"] = """
SELECT f.*, d.* EXCLUDE (date_sk), g.* EXCLUDE (geography_sk)
FROM fact_items f JOIN dim_geography g ON f.customer_geography_sk = g.geography_sk
JOIN dim_date d ON f.date_sk = d.date_sk"""


def _time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%g') AS {column}"


# Half-up quotients of whole numbers, without a rounded double in between.
def _quotient(numerator: str, denominator: str, per: int) -> str:
    n, d = f"CAST({numerator} AS HUGEINT)", f"({denominator})"
    return (
        f"CASE WHEN {d} > 0 THEN ((2 * {per} * {n} + {d}) // (2 * {d})) / {per}.0 END"
    )


_HOURS = f"{_quotient('answer_minutes', '60', 100)} AS review_response_time_hours"
_MONEY = "price_c / 100.0 AS {}, freight_c / 100.0 AS freight_value, total_c / 100.0 AS total_item_value"
_ORDER_TIMES = ", ".join(
    _time(c)
    for c in (
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
)
_SHARE = _quotient("value_c", "payment_installments", 1)


def _revenue(where: str = "TRUE", limit: int = 100) -> str:
    return f"""
SELECT region, state, count(DISTINCT order_id) AS total_orders,
       sum(total_c) / 100.0 AS total_revenue,
       {_quotient('sum(total_c)', 'count(total_c)', 1)} / 100.0 AS avg_order_value,
       sum(freight_c) / 100.0 AS total_shipping_cost
FROM revenue WHERE {where} GROUP BY region, state
ORDER BY sum(total_c) DESC, region, state LIMIT {limit}"""


def _state_of(rows: str) -> str:
    return f"""
WITH newest AS (
  SELECT * FROM event_log WHERE {rows}
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY ts_ms DESC, kafka_offset DESC) = 1)
SELECT k, v FROM newest WHERE op <> 'd'"""


SQL: dict[str, str] = {
    "cdc_envelope_parse": "SELECT kafka_partition, kafka_offset, op, ts_ms, k, v FROM event_log",
    "cdc_envelope_bare": """
SELECT kafka_offset, CASE WHEN reason IS NULL THEN op END AS op,
       CASE WHEN reason IS NULL THEN k END AS k, CASE WHEN reason IS NULL THEN v END AS v, reason
FROM (SELECT *, CASE WHEN kafka_offset % 11 = 0 THEN 'empty message'
                     WHEN kafka_offset % 7 = 0 THEN 'not a change envelope' END AS reason
      FROM event_log)""",
    "cdc_latest_reference": _state_of("op <> 'd'"),
    "cdc_latest_delete_aware": _state_of("TRUE"),
    "cdc_latest_composite": """
SELECT order_id, CAST(order_item_id AS VARCHAR) AS order_item_id, product_id, seller_id,
       CAST(epoch_ms(shipping_limit_date) AS VARCHAR) AS shipping_limit_date,
       CAST(CAST(price_c / 100.0 AS DECIMAL(18,2)) AS VARCHAR) AS price,
       CAST(CAST(freight_c / 100.0 AS DECIMAL(18,2)) AS VARCHAR) AS freight_value
FROM silver_order_items""",
    "sample_changes": """
SELECT op, ts_ms, CASE WHEN op <> 'd' THEN k END AS k, v FROM event_log
ORDER BY ts_ms, kafka_partition, kafka_offset LIMIT 5""",
    "cdc_topic_routing": """
SELECT concat('shop.', event_type) AS topic, kafka_partition, kafka_offset, op, ts_ms, k, v FROM event_log""",
    "cdc_unknown_topic": """
SELECT concat('shop.', event_type) AS topic, kafka_partition, kafka_offset, k,
       CASE WHEN event_type = 'error' THEN 'd' ELSE op END AS op
FROM event_log WHERE event_type IN ('error', 'view')""",
    "cdc_rejected_shapes": f"""
SELECT event_id AS kafka_offset, CASE WHEN event_id % 8 <> 7 THEN {SHAPES_SQL} END AS raw,
       CASE event_id % 8 WHEN 0 THEN 'unknown operation' WHEN 1 THEN 'no row image'
            WHEN 2 THEN 'no row image' WHEN 3 THEN 'no change time' WHEN 4 THEN 'unknown operation'
            WHEN 6 THEN 'no key' ELSE 'empty message' END AS reason
FROM events WHERE event_id % 8 <> 5""",
    "insert_if_absent": """
WITH target AS (SELECT * FROM lineitem WHERE l_linestatus = 'O'),
fresh AS (
  SELECT * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                             ORDER BY l_shipdate, l_partkey, l_suppkey) = 1),
merged AS (
  SELECT * FROM target
  UNION ALL
  SELECT * FROM fresh f WHERE NOT EXISTS (
    SELECT 1 FROM target t
    WHERE t.l_orderkey = f.l_orderkey AND t.l_linenumber = f.l_linenumber))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%g') AS l_shipdate, l_linestatus
FROM merged""",
    "csv_typed_load": f"SELECT order_id, customer_id, order_status, {_ORDER_TIMES} FROM src_orders",
    "silver_customers": "SELECT * FROM silver_customers",
    "silver_geolocation": "SELECT * FROM silver_geolocation",
    "silver_sellers": "SELECT * FROM silver_sellers",
    "silver_category_translation": "SELECT * FROM silver_category_translation",
    "silver_products": "SELECT * FROM silver_products",
    "silver_orders": f"""
SELECT * REPLACE ({_ORDER_TIMES}) FROM silver_orders""",
    "silver_order_items": f"""
SELECT order_id, order_item_id, product_id, seller_id, {_time('shipping_limit_date')},
       {_MONEY.format('price')},
       {_quotient('freight_c', 'price_c', 10000)} AS freight_ratio
FROM silver_order_items""",
    "silver_payments": f"""
SELECT order_id, payment_sequential, payment_type, payment_installments,
       value_c / 100.0 AS payment_value,
       CASE WHEN payment_installments > 0 THEN {_SHARE} ELSE value_c END / 100.0
         AS installment_value,
       coalesce(payment_installments > 1, FALSE) AS is_installment_payment
FROM silver_payments""",
    "silver_reviews": f"""
SELECT review_id, order_id, review_score, review_comment_title, review_comment_message,
       {_time('review_creation_date')}, {_time('review_answer_timestamp')},
       review_rating, has_comment, {_HOURS}
FROM silver_reviews""",
    "gold_dim_geography": "SELECT * FROM dim_geography",
    "gold_dim_date": "SELECT * REPLACE (strftime(full_date, '%Y-%m-%d') AS full_date) FROM dim_date",
    "gold_dim_customer": "SELECT * FROM dim_customer",
    "gold_dim_seller": "SELECT * FROM dim_seller",
    "gold_dim_product": "SELECT * FROM dim_product",
    "gold_dim_order_status": "SELECT * FROM dim_order_status",
    "gold_fact_order_items": f"""
SELECT * EXCLUDE (price_c, freight_c, total_c, order_purchase_timestamp, order_approved_at,
                  order_delivered_customer_date, shipping_limit_date),
       {_MONEY.format('unit_price')},
       {_time('order_purchase_timestamp')}, {_time('order_approved_at')},
       {_time('order_delivered_customer_date')}, {_time('shipping_limit_date')}
FROM fact_items""",
    "gold_fact_reviews": f"""
SELECT * EXCLUDE (answer_minutes, review_creation_date, review_answer_timestamp), {_HOURS},
       {_time('review_creation_date')}, {_time('review_answer_timestamp')}
FROM fact_reviews""",
    "key_dense": """
SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_sk, o_orderkey, o_custkey,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%g') AS o_orderdate
FROM orders""",
    "q_customer_count": "SELECT count(*) AS customer_count FROM dim_customer WHERE customer_sk <> -1",
    "q_customer_count_with_unknown": "SELECT count(*) AS customer_count FROM dim_customer",
    "q_product_count": """
SELECT count(DISTINCT product_id) AS product_count FROM dim_product WHERE product_sk <> -1""",
    "q_revenue_by_region": _revenue(limit=5),
    "q_top_categories": f"""
SELECT product_category_name_english AS category, count(*) AS items_sold,
       count(DISTINCT order_id) AS order_count, sum(price_c) / 100.0 AS total_sales,
       {_quotient('sum(price_c)', 'count(price_c)', 1)} / 100.0 AS avg_price
FROM fact_items f JOIN dim_product p ON f.product_sk = p.product_sk
JOIN dim_date d ON f.date_sk = d.date_sk
GROUP BY product_category_name_english ORDER BY sum(price_c) DESC, category LIMIT 5""",
    "q_filter_eq": _revenue("region = 'SUL'"),
    "q_filter_gte": _revenue("full_date >= DATE '1998-01-01'"),
    "q_filter_lte": _revenue("full_date <= DATE '1997-06-30'"),
    "q_filter_gt": _revenue("price_c > 5000050"),
    "q_filter_lt": _revenue("date_sk < 19970101"),
    "q_filter_like": _revenue("city LIKE '%Y 1%'"),
    "q_filter_in": _revenue("state IN ('SP', 'BA')"),
    "q_filter_timestamp": _revenue("order_purchase_timestamp >= TIMESTAMP '1996-07-01 12:00:00'"),
    "q_filter_wildcard": _revenue("city LIKE 'C_TY%1'"),
    "q_filter_and": _revenue(
        "full_date >= DATE '1996-01-01' AND full_date <= DATE '1999-12-31' "
        "AND region IN ('SUDESTE', 'NORTE') AND is_delivered"
    ),
    "q_limit": _revenue(limit=3),
    "report_by_state": """
SELECT customer_state, count(*) AS count FROM silver_customers
GROUP BY customer_state ORDER BY count DESC, customer_state LIMIT 10""",
    "report_by_city": """
SELECT customer_city, customer_state, count(*) AS count FROM silver_customers
GROUP BY ALL ORDER BY count DESC, customer_city, customer_state LIMIT 10""",
    "report_one_state": """
SELECT customer_id, customer_city, customer_zip_code_prefix FROM silver_customers
WHERE customer_state = 'SP' ORDER BY customer_id LIMIT 10""",
}

SQL["cdc_stream_append"] = SQL["cdc_stream_replay"] = SQL["cdc_envelope_parse"]
SQL["cdc_stream_compacted"] = SQL["cdc_one_topic_sink"] = SQL["cdc_envelope_parse"]
SQL["cdc_catch_up_topics"] = """
SELECT event_type AS topic, kafka_partition, kafka_offset, op, ts_ms, k, v FROM event_log"""
# Layers that grow batch by batch end where a whole build does.
SQL |= {n.replace("silver_", "silver_incremental_"): text for n, text in SQL.items() if n.startswith("silver_")}


def _named(text: str, names: dict[str, tuple[str, str, str]]) -> str:
    """A fact with business keys for surrogate ones: column -> (dimension, its key, business key)."""
    columns = ", ".join(f"d_{c}.{name} AS {c.removesuffix('_sk')}_name" for c, (_, _, name) in names.items())
    joins = " ".join(f"JOIN {dim} d_{c} ON d_{c}.{key} = f.{c}" for c, (dim, key, _) in names.items())
    return f"SELECT f.* EXCLUDE ({', '.join(names)}), {columns} FROM ({text}) f {joins}"


_PERSON = {"customer_sk": ("dim_customer", "customer_sk", "customer_unique_id"), "product_sk": ("dim_product", "product_sk", "product_id")}
_PLACE = ("dim_geography", "geography_sk", "zip_code_prefix")
SQL["gold_incremental_order_items"] = _named(
    SQL["gold_fact_order_items"],
    _PERSON
    | {
        "seller_sk": ("dim_seller", "seller_sk", "seller_id"),
        "order_status_sk": ("dim_order_status", "order_status_sk", "order_status"),
        "customer_geography_sk": _PLACE,
        "seller_geography_sk": _PLACE,
    },
)
SQL["gold_incremental_reviews"] = _named(SQL["gold_fact_reviews"], _PERSON | {"customer_geography_sk": _PLACE})
# A new checkpoint reads everything again, beside what the old one stored.
SQL["cdc_stream_new_checkpoint"] = f"""
SELECT *, 2 AS stored FROM ({SQL['cdc_envelope_parse']})"""
SQL["insert_if_absent_stored"] = """
WITH first AS (
  SELECT *, l_linestatus <> 'F' AS later FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                             ORDER BY l_linestatus <> 'F', l_shipdate, l_partkey, l_suppkey) = 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%g') AS l_shipdate, l_linestatus
FROM first"""
SQL["key_registry"] = """
SELECT o_orderkey, o_orderstatus,
       row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_orderkey) AS order_sk
FROM orders"""
SQL["key_refresh"] = """
WITH first AS (
  SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS order_sk FROM orders WHERE o_orderstatus = 'F'),
later AS (
  SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) + (SELECT count(*) FROM first) AS order_sk
  FROM orders WHERE o_orderstatus <> 'F')
SELECT o_orderkey, order_sk FROM first UNION ALL SELECT * FROM later"""

_REVIEW_ANALYSIS = f"""
SELECT product_category_name_english AS category, count(*) AS total_reviews,
       {_quotient('sum(review_score)', 'count(review_score)', 100)} AS avg_score,
       CAST(sum(is_positive) AS BIGINT) AS positive_reviews,
       CAST(sum(is_negative) AS BIGINT) AS negative_reviews,
       CAST(sum(is_neutral) AS BIGINT) AS neutral_reviews,
       {_quotient('100 * sum(is_positive)', 'count(*)', 100)} AS positive_rate_pct
FROM fact_reviews r JOIN dim_product p ON r.product_sk = p.product_sk
JOIN dim_date d ON r.review_date_sk = d.date_sk
GROUP BY product_category_name_english ORDER BY total_reviews DESC, category LIMIT 5"""

SQL["q_review_analysis"] = _REVIEW_ANALYSIS

# --- quality ---------------------------------------------------------------

_TABLES = {
    "customers": ("silver_customers", ["customer_id"]),
    "geolocation": ("silver_geolocation", ["zip_code_prefix", "city", "state"]),
    "sellers": ("silver_sellers", ["seller_id"]),
    "category_translation": ("silver_category_translation", ["product_category_name"]),
    "products": ("silver_products", ["product_id"]),
    "orders": ("silver_orders", ["order_id"]),
    "order_items": ("silver_order_items", ["order_id", "order_item_id"]),
    "order_payments": ("silver_payments", ["order_id", "payment_sequential"]),
    "order_reviews": ("silver_reviews", ["review_id", "order_id"]),
}

# Silver columns as the view shows them: name in the report -> expression in the view.
_COLUMNS = {
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
    "geolocation": ["zip_code_prefix", "city", "state", "avg_latitude", "avg_longitude"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "category_translation": ["product_category_name", "product_category_name_english"],
    "products": ["product_id", "product_category_name", "product_name_length", "product_description_length", "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm", "product_volume_cm3"],
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date", "order_year", "order_month", "order_day", "order_hour", "approval_delay_days", "actual_delivery_days", "estimated_delivery_days", "delivery_delay_days", "is_delivered_late", "is_delivered"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price=price_c", "freight_value=freight_c", "total_item_value=total_c", "freight_ratio=CASE WHEN price_c > 0 THEN freight_c END"],
    "order_payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value=value_c", "installment_value=value_c", "is_installment_payment=0"],
    "order_reviews": ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message", "review_creation_date", "review_answer_timestamp", "review_rating", "has_comment", "review_response_time_hours=answer_minutes"],
}

_RULES = {
    ("customers", "Valid State Code"): "regexp_matches(customer_state, '^[A-Z]{2}$')",
    ("customers", "Valid Zip Code"): "regexp_matches(customer_zip_code_prefix, '^[0-9]{5}$')",
    ("geolocation", "Valid Latitude"): "avg_latitude BETWEEN -90 AND 90",
    ("geolocation", "Valid Longitude"): "avg_longitude BETWEEN -180 AND 180",
    ("sellers", "Valid State Code"): "regexp_matches(seller_state, '^[A-Z]{2}$')",
    ("products", "Positive Weight"): "product_weight_g IS NULL OR product_weight_g > 0",
    ("products", "Positive Volume"): "product_volume_cm3 IS NULL OR product_volume_cm3 > 0",
    ("orders", "Valid Status"): "order_status IN ('DELIVERED','SHIPPED','CANCELED','UNAVAILABLE','INVOICED','PROCESSING','CREATED','APPROVED')",
    ("orders", "Purchase Before Delivery"): "order_delivered_customer_date IS NULL OR order_purchase_timestamp <= order_delivered_customer_date",
    ("order_items", "Positive Price"): "price_c >= 0",
    ("order_items", "Positive Freight"): "freight_c >= 0",
    ("order_items", "Valid Total"): "total_c >= 0",
    ("order_payments", "Valid Payment Type"): "payment_type IN ('CREDIT_CARD','BOLETO','VOUCHER','DEBIT_CARD')",
    ("order_payments", "Positive Amount"): "value_c > 0",
    ("order_payments", "Valid Installments"): "payment_installments >= 1",
    ("order_reviews", "Valid Score"): "review_score BETWEEN 1 AND 5",
    ("order_reviews", "Valid Rating"): "review_rating IN ('POSITIVE','NEUTRAL','NEGATIVE','UNKNOWN')",
}

_FOREIGN_KEYS = [
    ("orders", "customer_id", "silver_customers"),
    ("order_items", "order_id", "silver_orders"),
    ("order_items", "product_id", "silver_products"),
    ("order_items", "seller_id", "silver_sellers"),
    ("order_payments", "order_id", "silver_orders"),
    ("order_reviews", "order_id", "silver_orders"),
]


def _verdict(counts: list[str]) -> str:
    """Rows of (table, check, checked, violations, unknown) -> the report."""
    return f"""
SELECT table_name, check_name, checked, violations, unknown,
       round(100.0 * violations / checked, 2) AS violation_pct, violations = 0 AS passed
FROM ({' UNION ALL '.join(counts)})"""


def _count(table: str, check: str, relation: str, violations: str, unknown: str = "0") -> str:
    return (
        f"SELECT '{table}' AS table_name, '{check}' AS check_name, count(*) AS checked, "
        f"CAST({violations} AS BIGINT) AS violations, CAST({unknown} AS BIGINT) AS unknown "
        f"FROM {relation}"
    )


def _nulls(table: str, column: str) -> str:
    name, _, expression = column.partition("=")
    relation = _TABLES[table][0]
    return _count(table, name, relation, f"count(*) - count({expression or name})")


SQL["dq_null_keys"] = _verdict([_nulls(t, k) for t, (_, keys) in _TABLES.items() for k in keys])
SQL["dq_null_profile"] = _verdict([_nulls(t, c) for t, cols in _COLUMNS.items() for c in cols])
SQL["dq_rules"] = _verdict(
    [
        _count(
            table,
            rule,
            _TABLES[table][0],
            f"count(*) FILTER (WHERE NOT ({condition}))",
            f"count(*) FILTER (WHERE ({condition}) IS NULL)",
        )
        for (table, rule), condition in _RULES.items()
    ]
)
SQL["dq_duplicates"] = _verdict(
    [
        _count(table, ", ".join(keys), relation, f"count(*) - count(DISTINCT ({', '.join(keys)}))")
        for table, (relation, keys) in [
            *_TABLES.items(),
            ("lineitem", ("lineitem", ["l_orderkey", "l_linenumber"])),
        ]
    ]
)
SQL["dq_orphans"] = _verdict(
    [
        _count(
            table,
            column,
            f"{_TABLES[table][0]} c LEFT JOIN {parent} p USING ({column})",
            f"count(c.{column}) - count(p.{column})",
            f"count(*) - count(c.{column})",
        )
        for table, column, parent in _FOREIGN_KEYS
    ]
)
# Checks that are kept up batch by batch end where a whole count does.
SQL |= {n.replace("dq_", "dq_kept_"): SQL[n] for n in ("dq_null_profile", "dq_rules", "dq_orphans")}
SQL["dq_kept_duplicates"] = f"SELECT * FROM ({SQL['dq_duplicates']}) WHERE table_name <> 'lineitem'"
_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, 'OK' AS status FROM {relation}"
    for t, (relation, _) in _TABLES.items()
)
_GOLD = ("dim_geography", "dim_date", "dim_customer", "dim_seller", "dim_product", "dim_order_status")
SQL["run_report"] = " UNION ALL ".join(
    ["SELECT 'ingest' AS step, 'OK' AS status, CAST(NULL AS BIGINT) AS row_count"]
    + [
        f"SELECT '{t}', 'OK', count(*) FROM {relation}"
        for t, relation in [
            *((t, relation) for t, (relation, _) in _TABLES.items()),
            *zip(_GOLD, _GOLD),
            ("fact_order_items", "fact_items"),
            ("fact_reviews", "fact_reviews"),
        ]
    ]
)
SQL["layer_summary"] = f"""
WITH counted AS ({_COUNTS})
SELECT * FROM counted UNION ALL SELECT 'TOTAL', sum(row_count)::BIGINT, 'OK' FROM counted"""


def _needed(text: str, found: dict[str, str]) -> None:
    """Collect the views a text refers to, those they build on first."""
    for name, body in VIEWS.items():
        if name not in found and re.search(rf"\b{name}\b", text):
            _needed(body, found)
            found[name] = body


def with_views(text: str) -> str:
    found: dict[str, str] = {}
    _needed(text, found)
    if not found:
        return text.strip()
    views = ",\n".join(f"{name} AS MATERIALIZED ({body})" for name, body in found.items())
    text = text.strip()
    if text.startswith("WITH "):
        return f"WITH {views},\n{text.removeprefix('WITH ')}"
    return f"WITH {views}\n{text}"


# Column order of the described query, with the first row as example.
_DESCRIBED = (
    "category",
    "total_reviews",
    "avg_score",
    "positive_reviews",
    "negative_reviews",
    "neutral_reviews",
    "positive_rate_pct",
)
SQL["q_schema"] = f"""
WITH analysis AS ({_REVIEW_ANALYSIS}),
first_row AS (SELECT * FROM analysis ORDER BY total_reviews DESC, category LIMIT 1),
described (position, name) AS (VALUES {', '.join(f"({i}, '{c}')" for i, c in enumerate(_DESCRIBED))})
SELECT position, name,
       CASE name {' '.join(f"WHEN '{c}' THEN CAST({c} AS VARCHAR)" for c in _DESCRIBED)} END AS example
FROM described LEFT JOIN first_row ON TRUE"""

ORACLE = {name: with_views(text) for name, text in SQL.items()}
