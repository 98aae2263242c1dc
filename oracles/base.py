"""Common table expressions: base tables -> raw tables -> star tables.

Money is summed as DECIMAL(38,8), finer than any amount, so sums are exact and independent of
row order.
"""

RAW = """
ship AS (
  SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey
),
raw_orders AS (
  SELECT o_orderkey AS order_id,
         o_orderkey AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                            WHEN 'P' THEN 'canceled' END AS order_status,
         o_orderdate + (o_orderkey * 7 % 24) * INTERVAL 1 HOUR AS order_purchase_timestamp,
         o_orderdate + (24 + o_orderkey % 24) * INTERVAL 1 HOUR AS order_approved_at,
         handed_over - INTERVAL 2 DAY AS order_delivered_carrier_date,
         handed_over AS order_delivered_customer_date,
         o_orderdate + (10 + 5 * CAST(o_orderpriority[1] AS INTEGER)) * INTERVAL 1 DAY
           AS order_estimated_delivery_date
  FROM (
    SELECT o.*,
           o_orderdate
             + ((date_diff('day', o_orderdate, last_ship) % 75 + 75) % 75) * INTERVAL 1 DAY
             + (o_orderkey % 24) * INTERVAL 1 HOUR AS handed_over
    FROM orders o LEFT JOIN ship ON ship.l_orderkey = o.o_orderkey
  )
),
raw_customers AS (
  SELECT o_orderkey AS customer_id,
         o_custkey AS customer_unique_id,
         lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
         c_mktsegment || '-' || o_orderpriority[1] AS customer_city,
         n_name AS customer_state
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
raw_order_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
         l_extendedprice AS price, l_quantity * 0.5 AS freight_value
  FROM lineitem
),
raw_order_payments AS (
  SELECT l_orderkey AS order_id,
         CASE l_linenumber % 4 WHEN 0 THEN 'boleto' WHEN 1 THEN 'credit_card'
                               WHEN 2 THEN 'debit_card' ELSE 'voucher' END AS payment_type,
         l_extendedprice AS payment_value
  FROM lineitem
),
raw_order_reviews AS (
  SELECT o_orderkey AS order_id,
         CAST(1 + CAST(floor(value) AS BIGINT) % 5 AS INTEGER) AS review_score,
         o_orderdate + (event_id % 60) * INTERVAL 1 DAY AS review_creation_date
  FROM events JOIN orders ON event_id // 2 = o_orderkey
),
raw_products AS (
  SELECT p_partkey AS product_id, p_type AS product_category_name,
         CAST(NULL AS INTEGER) AS product_name_lenght,
         CAST(NULL AS INTEGER) AS product_description_lenght,
         CAST(NULL AS INTEGER) AS product_photos_qty,
         CAST(p_size AS DOUBLE) AS product_weight_g,
         CAST(p_size AS DOUBLE) AS product_length_cm,
         CAST(p_size AS DOUBLE) AS product_height_cm,
         CAST(p_size AS DOUBLE) AS product_width_cm
  FROM part
),
raw_category_translation AS (
  SELECT DISTINCT p_type AS product_category_name,
         lower(p_type) || '_en' AS product_category_name_english
  FROM part WHERE p_type <> 'PROMO'
),
raw_sellers AS (
  SELECT s_suppkey AS seller_id,
         lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
         CAST(NULL AS VARCHAR) AS seller_city,
         n_name AS seller_state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""

STAR = """
dim_customers AS (
  SELECT customer_sk, home.zip AS zip_code_prefix, home.city AS city, home.state AS state,
         n_customer_ids
  FROM (
    SELECT customer_unique_id AS customer_sk,
           arg_min({'zip': customer_zip_code_prefix, 'city': customer_city,
                    'state': customer_state}, customer_id) AS home,
           count(DISTINCT customer_id) AS n_customer_ids
    FROM raw_customers GROUP BY customer_unique_id
  )
),
dim_products AS (
  SELECT product_id AS product_sk, r.product_category_name AS category_pt,
         product_category_name_english AS category_en,
         product_name_lenght AS product_name_length,
         product_description_lenght AS product_description_length,
         product_photos_qty, product_weight_g, product_length_cm, product_height_cm,
         product_width_cm
  FROM raw_products r LEFT JOIN raw_category_translation tr
    ON tr.product_category_name = r.product_category_name
),
dim_sellers AS (
  SELECT seller_id AS seller_sk, seller_zip_code_prefix AS zip_code_prefix,
         seller_city AS city, seller_state AS state
  FROM raw_sellers
),
dim_date AS (
  SELECT date_sk,
         CAST(year(date_sk) AS INTEGER) AS year, CAST(month(date_sk) AS INTEGER) AS month,
         CAST(day(date_sk) AS INTEGER) AS day,
         CAST(dayofweek(date_sk) AS INTEGER) AS day_of_week,
         strftime(date_sk, '%Y-%m') AS year_month
  FROM (
    SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_sk
    FROM (SELECT min(CAST(order_purchase_timestamp AS DATE)) AS lo,
                 max(CAST(order_purchase_timestamp AS DATE)) AS hi FROM raw_orders)
  )
),
fact_order_items AS (
  SELECT order_id, order_item_id, product_id AS product_sk, seller_id AS seller_sk,
         shipping_limit_date, price, freight_value
  FROM raw_order_items
),
payments_rollup AS (
  SELECT order_id,
         CAST(sum(CAST(payment_value AS DECIMAL(38,8))) AS DOUBLE) AS payment_value_total,
         count(*) AS n_payment_lines, max(payment_type) AS payment_type_primary
  FROM raw_order_payments GROUP BY order_id
),
reviews_rollup AS (
  SELECT order_id, avg(CAST(review_score AS DOUBLE)) AS review_score_avg,
         count(*) AS n_reviews
  FROM raw_order_reviews GROUP BY order_id
),
items_rollup AS (
  SELECT order_id,
         CAST(sum(CAST(price AS DECIMAL(38,8))) AS DOUBLE) AS gmv_items,
         CAST(sum(CAST(freight_value AS DECIMAL(38,8))) AS DOUBLE) AS freight_total,
         count(*) AS n_items
  FROM fact_order_items GROUP BY order_id
),
fact_orders AS (
  SELECT o.order_id, c.customer_unique_id AS customer_sk, order_status,
         order_purchase_timestamp,
         CAST(order_purchase_timestamp AS DATE) AS purchase_date_sk,
         order_approved_at, order_delivered_carrier_date, order_delivered_customer_date,
         order_estimated_delivery_date,
         order_delivered_customer_date <= order_estimated_delivery_date AS delivered_on_time,
         coalesce(payment_value_total, 0.0::DOUBLE) AS payment_value_total,
         coalesce(n_payment_lines, 0) AS n_payment_lines,
         payment_type_primary, review_score_avg,
         coalesce(n_reviews, 0) AS n_reviews,
         coalesce(gmv_items, 0.0::DOUBLE) AS gmv_items,
         coalesce(freight_total, 0.0::DOUBLE) AS freight_total,
         coalesce(n_items, 0) AS n_items
  FROM raw_orders o
  LEFT JOIN raw_customers c USING (customer_id)
  LEFT JOIN payments_rollup p ON p.order_id = o.order_id
  LEFT JOIN reviews_rollup v ON v.order_id = o.order_id
  LEFT JOIN items_rollup i ON i.order_id = o.order_id
)"""


def on_star(body: str, *more: str) -> str:
    """A query over the raw and star tables as common table expressions."""
    ctes = ",".join([RAW, STAR, *more])
    return f"WITH {ctes.strip()}\n{body.strip()}"


def money(column: str) -> str:
    """Exact sum of a money column, as double."""
    return f"CAST(sum(CAST({column} AS DECIMAL(38,8))) AS DOUBLE)"


def steady_mean(column: str, bits: int = 40) -> str:
    """Mean of a column of quotients, each taken as a whole number of 2^-bits, which makes the
    sum exact; null where there is nothing."""
    unit = f"{1 << bits}::DOUBLE"
    return (
        f"CAST(sum(CAST(floor({column} * {unit} + 0.5::DOUBLE) AS HUGEINT)) AS DOUBLE) / {unit} "
        f"/ nullif(count({column}), 0)"
    )
