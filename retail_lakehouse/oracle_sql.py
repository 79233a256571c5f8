"""Independent DuckDB SQL for every registered query.

The star-schema tables are views in DuckDB; each oracle query re-derives the
landing inputs, bronze, silver, gold and mart layers as CTEs and then selects
the same columns, with the same names and types, as the Spark query. It is
written in SQL from the table definitions, not generated from the Spark
plans, so the two sides check each other.
"""

from __future__ import annotations

from retail_lakehouse.schemas import DATASETS
from retail_lakehouse.sources import driver_tables as D

TS = "'%Y-%m-%d %H:%M:%S'"
SNAP = D.SNAPSHOT_DATE.isoformat()


def ts_text(x: str) -> str:
    return f"strftime({x}, {TS})"


def case_map(x: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {x} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} ELSE '' END"


def exact_q(num: str, den: str, scale: int, num_scale: int = 0, precision: int = 38) -> str:
    """round-half-away-from-zero(num / den) at ``scale`` digits on integers."""
    assert num_scale <= scale
    s = f"CAST(({num}) * {10 ** scale} AS HUGEINT)"
    d = f"CAST(NULLIF({den}, 0) AS HUGEINT)"
    q = f"(CASE WHEN {s} < 0 THEN -1 ELSE 1 END) * ((2 * abs({s}) + {d}) // (2 * {d}))"
    unit = "1" if scale == 0 else "0." + "0" * (scale - 1) + "1"
    return f"CAST(CAST({q} AS DECIMAL(20,0)) * {unit} AS DECIMAL({precision},{scale}))"


def exact_avg(col: str, scale: int, num_scale: int = 0, precision: int = 38) -> str:
    return exact_q(f"sum({col})", f"count({col})", scale, num_scale, precision)


def _money_text(x: str, p: int = 12, s: int = 2) -> str:
    return f"CAST(CAST({x} AS DECIMAL({p},{s})) AS VARCHAR)"


RAW = {
    "olist_orders": f"""
      SELECT CAST(o.o_orderkey AS VARCHAR) AS order_id,
             CAST(o.o_custkey AS VARCHAR) AS customer_id,
             {case_map('o.o_orderstatus', D.STATUS_BY_CODE)} AS order_status,
             {ts_text('o.o_orderdate')} AS order_purchase_timestamp,
             CASE WHEN o.o_orderstatus <> 'P' THEN {ts_text('o.o_orderdate')} ELSE '' END AS order_approved_at,
             CASE WHEN o.o_orderstatus <> 'P' THEN coalesce({ts_text('s.first_ship')}, '') ELSE '' END
                 AS order_delivered_carrier_date,
             CASE WHEN o.o_orderstatus = 'F' THEN coalesce({ts_text('s.last_ship')}, '') ELSE '' END
                 AS order_delivered_customer_date,
             {ts_text(f"CAST(o.o_orderdate AS DATE) + {D.ESTIMATE_DAYS}")} AS order_estimated_delivery_date
      FROM orders o
      LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
                 FROM lineitem GROUP BY l_orderkey) s ON o.o_orderkey = s.l_orderkey""",
    "olist_order_items": f"""
      SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
             CAST(l_linenumber AS VARCHAR) AS order_item_id,
             CAST(l_partkey AS VARCHAR) AS product_id,
             CAST(l_suppkey AS VARCHAR) AS seller_id,
             {ts_text('l_shipdate')} AS shipping_limit_date,
             CAST(price AS VARCHAR) AS price,
             CAST(freight AS VARCHAR) AS freight_value
      FROM li_amounts""",
    "olist_order_payments": f"""
      SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
             CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag ASC NULLS FIRST) AS VARCHAR)
                 AS payment_sequential,
             {case_map('l_returnflag', D.PAYMENT_TYPE_BY_FLAG)} AS payment_type,
             CAST(lines AS VARCHAR) AS payment_installments,
             {_money_text('value')} AS payment_value
      FROM (SELECT l_orderkey, l_returnflag, count(*) AS lines, sum(price + freight) AS value
            FROM li_amounts GROUP BY l_orderkey, l_returnflag)""",
    "olist_order_reviews": f"""
      SELECT CAST(event_id // 2 AS VARCHAR) AS review_id,
             CAST(event_id // 3 AS VARCHAR) AS order_id,
             CAST(1 + ((event_id % 5) + 5) % 5 AS VARCHAR) AS review_score,
             coalesce(event_type, '') AS review_comment_title,
             coalesce(props, '') AS review_comment_message,
             {ts_text('ts')} AS review_creation_date,
             CASE WHEN event_type = 'error' THEN '' ELSE {ts_text("ts + INTERVAL 1 DAY")} END
                 AS review_answer_timestamp
      FROM events""",
    "olist_customers": """
      SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
             CAST(c_custkey // 2 AS VARCHAR) AS customer_unique_id,
             CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix,
             coalesce(n_name, '') AS customer_city,
             coalesce(r_name, '') AS customer_state
      FROM customer LEFT JOIN geo ON c_nationkey = n_nationkey""",
    "olist_products": f"""
      SELECT CAST(p_partkey AS VARCHAR) AS product_id,
             coalesce(lower(p_type), '') AS product_category_name,
             CAST(length(p_name) AS VARCHAR) AS product_name_lenght,
             CAST(length(p_brand) * 10 AS VARCHAR) AS product_description_lenght,
             CAST(((p_size % 5) + 5) % 5 + 1 AS VARCHAR) AS product_photos_qty,
             {_money_text('p_retailprice')} AS product_weight_g,
             {_money_text('p_size')} AS product_length_cm,
             {_money_text('p_size * CAST(0.5 AS DECIMAL(2,1))')} AS product_height_cm,
             {_money_text('p_size * CAST(0.25 AS DECIMAL(3,2))')} AS product_width_cm
      FROM part""",
    "olist_sellers": """
      SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
             CAST(s_nationkey AS VARCHAR) AS seller_zip_code_prefix,
             coalesce(n_name, '') AS seller_city,
             coalesce(r_name, '') AS seller_state
      FROM supplier LEFT JOIN geo ON s_nationkey = n_nationkey""",
    "olist_geolocation": f"""
      SELECT CAST(c_nationkey AS VARCHAR) AS geolocation_zip_code_prefix,
             {_money_text('CAST(c_acctbal AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(3,2))', 18, 8)} AS geolocation_lat,
             {_money_text('CAST(c_acctbal AS DECIMAL(12,2)) * CAST(-0.001 AS DECIMAL(4,3))', 18, 8)} AS geolocation_lng,
             coalesce(n_name, '') AS geolocation_city,
             coalesce(r_name, '') AS geolocation_state
      FROM customer LEFT JOIN geo ON c_nationkey = n_nationkey
      UNION ALL
      SELECT CAST(s_nationkey AS VARCHAR),
             {_money_text('CAST(s_acctbal AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(3,2))', 18, 8)},
             {_money_text('CAST(s_acctbal AS DECIMAL(12,2)) * CAST(-0.001 AS DECIMAL(4,3))', 18, 8)},
             coalesce(n_name, ''),
             coalesce(r_name, '')
      FROM supplier LEFT JOIN geo ON s_nationkey = n_nationkey""",
    "product_category_name_translation": f"""
      SELECT product_category_name, product_category_name_english
      FROM (SELECT DISTINCT lower(p_type) AS product_category_name,
                   {case_map('lower(p_type)', D.CATEGORY_TRANSLATIONS)} AS product_category_name_english
            FROM part)
      WHERE product_category_name_english <> ''""",
}


def _bronze(table: str, cols: tuple[str, ...]) -> str:
    struct = ", ".join(f"{c} := {c}" for c in cols)
    return f"""
      SELECT DISTINCT {', '.join(cols)},
             sha256(to_json(struct_pack({struct}))) AS _row_hash,
             '{D.SOURCE_TABLE[table]}.parquet' AS _source_file,
             DATE '{SNAP}' AS _batch_date,
             TIMESTAMP '{SNAP} 00:00:00' AS _ingested_at,
             'snapshot-{SNAP}' AS _batch_id
      FROM raw_{table}"""


def _nz(c: str) -> str:
    return f"NULLIF({c}, '')"


def _try(c: str, t: str) -> str:
    return f"TRY_CAST(NULLIF({c}, '') AS {t})"


LIN = "_row_hash AS source_row_hash, _batch_date AS batch_date, _ingested_at AS ingested_at"

SILVER = {
    "orders": f"""
      SELECT {LIN}, {_nz('order_id')} AS order_id, {_nz('customer_id')} AS customer_id,
             {_nz('order_status')} AS order_status,
             {_try('order_purchase_timestamp', 'TIMESTAMP')} AS order_purchase_at,
             {_try('order_approved_at', 'TIMESTAMP')} AS order_approved_at,
             {_try('order_delivered_carrier_date', 'TIMESTAMP')} AS order_delivered_carrier_at,
             {_try('order_delivered_customer_date', 'TIMESTAMP')} AS order_delivered_customer_at,
             {_try('order_estimated_delivery_date', 'TIMESTAMP')} AS order_estimated_delivery_at
      FROM bronze_olist_orders""",
    "order_items": f"""
      SELECT sha256(concat_ws('||', order_id, order_item_id)) AS order_item_sk, {LIN},
             {_nz('order_id')} AS order_id, {_try('order_item_id', 'INTEGER')} AS order_item_id,
             {_nz('product_id')} AS product_id, {_nz('seller_id')} AS seller_id,
             {_try('shipping_limit_date', 'TIMESTAMP')} AS shipping_limit_at,
             {_try('price', 'DECIMAL(12,2)')} AS item_price,
             {_try('freight_value', 'DECIMAL(12,2)')} AS freight_value
      FROM bronze_olist_order_items""",
    "order_payments": f"""
      SELECT sha256(concat_ws('||', order_id, payment_sequential)) AS payment_sk, {LIN},
             {_nz('order_id')} AS order_id, {_try('payment_sequential', 'INTEGER')} AS payment_sequence,
             {_nz('payment_type')} AS payment_type,
             {_try('payment_installments', 'INTEGER')} AS payment_installments,
             {_try('payment_value', 'DECIMAL(12,2)')} AS payment_value
      FROM bronze_olist_order_payments""",
    "order_reviews": f"""
      SELECT * FROM (
        SELECT {LIN}, {_nz('review_id')} AS review_id, {_nz('order_id')} AS order_id,
               {_try('review_score', 'INTEGER')} AS review_score,
               {_nz('review_comment_title')} AS review_comment_title,
               {_nz('review_comment_message')} AS review_comment_message,
               {_try('review_creation_date', 'TIMESTAMP')} AS review_created_at,
               {_try('review_answer_timestamp', 'TIMESTAMP')} AS review_answered_at
        FROM bronze_olist_order_reviews)
      QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY review_answered_at DESC NULLS LAST,
                                 ingested_at DESC NULLS LAST, source_row_hash ASC NULLS LAST) = 1""",
    "customers": f"""
      SELECT {LIN}, {_nz('customer_id')} AS customer_id, {_nz('customer_unique_id')} AS customer_unique_id,
             {_try('customer_zip_code_prefix', 'INTEGER')} AS zip_code_prefix,
             {_nz('customer_city')} AS customer_city, {_nz('customer_state')} AS customer_state
      FROM bronze_olist_customers""",
    "products": f"""
      SELECT {LIN}, {_nz('product_id')} AS product_id, {_nz('product_category_name')} AS product_category_name,
             {_try('product_name_lenght', 'INTEGER')} AS product_name_length,
             {_try('product_description_lenght', 'INTEGER')} AS product_description_length,
             {_try('product_photos_qty', 'INTEGER')} AS product_photos_quantity,
             {_try('product_weight_g', 'DECIMAL(12,2)')} AS product_weight_g,
             {_try('product_length_cm', 'DECIMAL(12,2)')} AS product_length_cm,
             {_try('product_height_cm', 'DECIMAL(12,2)')} AS product_height_cm,
             {_try('product_width_cm', 'DECIMAL(12,2)')} AS product_width_cm
      FROM bronze_olist_products""",
    "sellers": f"""
      SELECT {LIN}, {_nz('seller_id')} AS seller_id,
             {_try('seller_zip_code_prefix', 'INTEGER')} AS zip_code_prefix,
             {_nz('seller_city')} AS seller_city, {_nz('seller_state')} AS seller_state
      FROM bronze_olist_sellers""",
    "geolocation": f"""
      SELECT zip_code_prefix,
             {exact_avg('latitude', 12, 8, 22)} AS latitude,
             {exact_avg('longitude', 12, 8, 22)} AS longitude,
             max(city) AS city, max(state) AS state
      FROM (SELECT {_try('geolocation_zip_code_prefix', 'INTEGER')} AS zip_code_prefix,
                   {_try('geolocation_lat', 'DECIMAL(18,8)')} AS latitude,
                   {_try('geolocation_lng', 'DECIMAL(18,8)')} AS longitude,
                   {_nz('geolocation_city')} AS city, {_nz('geolocation_state')} AS state
            FROM bronze_olist_geolocation)
      GROUP BY zip_code_prefix""",
    "product_category_translation": f"""
      SELECT product_category_name, min(product_category_name_english) AS product_category_name_english
      FROM (SELECT {_nz('product_category_name')} AS product_category_name,
                   {_nz('product_category_name_english')} AS product_category_name_english
            FROM bronze_product_category_name_translation)
      GROUP BY product_category_name""",
}


def _dim_date(iso: bool) -> str:
    dow = "isodow(date_day)" if iso else "dayofweek(date_day) + 1"
    return f"""
      SELECT CAST(strftime(date_day, '%Y%m%d') AS INTEGER) AS date_key, date_day,
             CAST(year(date_day) AS INTEGER) AS year_number,
             CAST(quarter(date_day) AS INTEGER) AS quarter_number,
             CAST(month(date_day) AS INTEGER) AS month_number,
             monthname(date_day) AS month_name,
             CAST(week(date_day) AS INTEGER) AS week_number,
             CAST({dow} AS INTEGER) AS day_of_week_number,
             dayname(date_day) AS day_of_week_name,
             dayofweek(date_day) IN (0, 6) AS is_weekend
      FROM (SELECT CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS date_day
            FROM (SELECT min(CAST(order_purchase_at AS DATE)) AS start_date,
                         greatest(max(CAST(order_purchase_at AS DATE)),
                                  max(CAST(order_estimated_delivery_at AS DATE))) AS end_date
                  FROM silver_orders) b
            WHERE start_date IS NOT NULL AND end_date IS NOT NULL)"""


GOLD = {
    "dim_customers": """
      SELECT customer_id, customer_unique_id, zip_code_prefix, customer_city, customer_state
      FROM silver_customers""",
    "dim_products": """
      SELECT p.product_id, p.product_category_name,
             coalesce(t.product_category_name_english, p.product_category_name, 'unknown')
                 AS product_category_name_english,
             p.product_name_length, p.product_description_length, p.product_photos_quantity,
             p.product_weight_g, p.product_length_cm, p.product_height_cm, p.product_width_cm
      FROM silver_products p
      LEFT JOIN silver_product_category_translation t ON p.product_category_name = t.product_category_name""",
    "dim_sellers": "SELECT seller_id, zip_code_prefix, seller_city, seller_state FROM silver_sellers",
    "dim_geography": "SELECT zip_code_prefix, latitude, longitude, city, state FROM silver_geolocation",
    "dim_date": _dim_date(False),
    "dim_date_iso": _dim_date(True),
    "fct_orders": f"""
      SELECT o.order_id, o.customer_id, o.order_status,
             CAST(o.order_purchase_at AS DATE) AS order_purchase_date,
             o.order_purchase_at, o.order_approved_at, o.order_delivered_carrier_at,
             o.order_delivered_customer_at, o.order_estimated_delivery_at,
             coalesce(i.item_count, 0) AS item_count,
             coalesce(i.distinct_product_count, 0) AS distinct_product_count,
             coalesce(i.distinct_seller_count, 0) AS distinct_seller_count,
             CAST(coalesce(i.item_subtotal, 0) AS DECIMAL(14,2)) AS item_subtotal,
             CAST(coalesce(i.freight_total, 0) AS DECIMAL(14,2)) AS freight_total,
             CAST(coalesce(i.order_line_total, 0) AS DECIMAL(14,2)) AS order_line_total,
             coalesce(p.payment_count, 0) AS payment_count,
             CAST(coalesce(p.payment_total, 0) AS DECIMAL(14,2)) AS payment_total,
             coalesce(r.review_count, 0) AS review_count,
             r.average_review_score
      FROM silver_orders o
      LEFT JOIN (SELECT order_id, count(*) AS item_count,
                        count(DISTINCT product_id) AS distinct_product_count,
                        count(DISTINCT seller_id) AS distinct_seller_count,
                        sum(item_price) AS item_subtotal, sum(freight_value) AS freight_total,
                        sum(item_price + freight_value) AS order_line_total
                 FROM silver_order_items GROUP BY order_id) i ON o.order_id = i.order_id
      LEFT JOIN (SELECT order_id, count(*) AS payment_count, sum(payment_value) AS payment_total
                 FROM silver_order_payments GROUP BY order_id) p ON o.order_id = p.order_id
      LEFT JOIN (SELECT order_id, count(*) AS review_count,
                        {exact_avg('review_score', 2, 0, 4)} AS average_review_score
                 FROM silver_order_reviews GROUP BY order_id) r ON o.order_id = r.order_id""",
    "fct_order_items": """
      SELECT i.order_item_sk, i.order_id, CAST(o.order_purchase_at AS DATE) AS order_purchase_date,
             i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_at, i.item_price, i.freight_value,
             CAST(i.item_price + i.freight_value AS DECIMAL(14,2)) AS order_line_total
      FROM silver_order_items i JOIN silver_orders o ON i.order_id = o.order_id""",
}


def _delivery(elapsed: bool) -> str:
    late = "order_delivered_customer_at > order_estimated_delivery_at"
    if elapsed:
        d1 = "(epoch_us(order_delivered_customer_at) - epoch_us(order_purchase_at))"
        d2 = "(epoch_us(order_delivered_customer_at) - epoch_us(order_estimated_delivery_at))"
        days1 = exact_q(f"sum({d1})", f"count({d1}) * 86400000000", 2, 0, 10)
        days2 = exact_q(f"sum({d2})", f"count({d2}) * 86400000000", 2, 0, 10)
    else:
        d1 = "date_diff('day', CAST(order_purchase_at AS DATE), CAST(order_delivered_customer_at AS DATE))"
        d2 = ("date_diff('day', CAST(order_estimated_delivery_at AS DATE), "
              "CAST(order_delivered_customer_at AS DATE))")
        days1 = exact_avg(d1, 2, 0, 10)
        days2 = exact_avg(d2, 2, 0, 10)
    return f"""
      SELECT order_purchase_date, count(*) AS order_count,
             count(*) FILTER (WHERE order_delivered_customer_at IS NOT NULL) AS delivered_order_count,
             count(*) FILTER (WHERE {late}) AS late_delivery_count,
             {exact_q(f"count(*) FILTER (WHERE {late})",
                      "count(*) FILTER (WHERE order_delivered_customer_at IS NOT NULL)", 4, 0, 8)}
                 AS late_delivery_rate,
             {days1} AS average_delivery_days,
             {days2} AS average_days_vs_estimate
      FROM fct_orders GROUP BY order_purchase_date"""


MART = {
    "mart_daily_sales": f"""
      SELECT order_purchase_date, count(*) AS order_count, CAST(sum(item_count) AS BIGINT) AS item_count,
             CAST(sum(item_subtotal) AS DECIMAL(16,2)) AS item_subtotal,
             CAST(sum(freight_total) AS DECIMAL(16,2)) AS freight_total,
             CAST(sum(order_line_total) AS DECIMAL(16,2)) AS order_line_total,
             CAST(sum(payment_total) AS DECIMAL(16,2)) AS payment_total,
             {exact_avg('average_review_score', 2, 2, 4)} AS average_review_score
      FROM fct_orders GROUP BY order_purchase_date""",
    "mart_delivery_performance": _delivery(False),
    "mart_delivery_performance_elapsed": _delivery(True),
    "mart_seller_performance": f"""
      SELECT s.seller_id, s.seller_city, s.seller_state, s.zip_code_prefix,
             o.order_count, i.item_count, i.item_subtotal, i.freight_total, i.order_line_total,
             i.average_item_price, o.average_review_score, o.first_order_date, o.last_order_date
      FROM dim_sellers s
      JOIN (SELECT seller_id, count(*) AS item_count,
                   CAST(sum(item_price) AS DECIMAL(16,2)) AS item_subtotal,
                   CAST(sum(freight_value) AS DECIMAL(16,2)) AS freight_total,
                   CAST(sum(order_line_total) AS DECIMAL(16,2)) AS order_line_total,
                   {exact_avg('item_price', 2, 2, 14)} AS average_item_price
            FROM fct_order_items GROUP BY seller_id) i ON s.seller_id = i.seller_id
      JOIN (SELECT seller_id, count(*) AS order_count, min(order_purchase_date) AS first_order_date,
                   max(order_purchase_date) AS last_order_date,
                   {exact_avg('average_review_score', 2, 2, 4)} AS average_review_score
            FROM (SELECT DISTINCT i.seller_id, o.order_id, o.order_purchase_date, o.average_review_score
                  FROM fct_order_items i JOIN fct_orders o ON i.order_id = o.order_id)
            GROUP BY seller_id) o ON s.seller_id = o.seller_id""",
    "mart_customer_rfm": f"""
      SELECT customer_unique_id, snapshot_date, last_order_date, recency_days, order_count,
             monetary_value, average_order_value, recency_score, frequency_score, monetary_score,
             concat(recency_score, frequency_score, monetary_score) AS rfm_score
      FROM (
        SELECT *,
               CAST(6 - ntile(5) OVER (ORDER BY recency_days ASC NULLS FIRST,
                                       customer_unique_id ASC NULLS FIRST) AS INTEGER) AS recency_score,
               CAST(ntile(5) OVER (ORDER BY order_count ASC NULLS FIRST,
                                   customer_unique_id ASC NULLS FIRST) AS INTEGER) AS frequency_score,
               CAST(ntile(5) OVER (ORDER BY monetary_value ASC NULLS FIRST,
                                   customer_unique_id ASC NULLS FIRST) AS INTEGER) AS monetary_score
        FROM (
          SELECT co.customer_unique_id, rd.snapshot_date, max(co.order_purchase_date) AS last_order_date,
                 CAST(date_diff('day', max(co.order_purchase_date), rd.snapshot_date) AS INTEGER) AS recency_days,
                 count(DISTINCT co.order_id) AS order_count,
                 CAST(sum(co.payment_total) AS DECIMAL(16,2)) AS monetary_value,
                 {exact_avg('co.payment_total', 2, 2, 14)} AS average_order_value
          FROM (SELECT c.customer_unique_id, o.order_id, o.order_purchase_date, o.payment_total
                FROM fct_orders o JOIN dim_customers c ON o.customer_id = c.customer_id) co,
               (SELECT CAST(max(o.order_purchase_date) + 1 AS DATE) AS snapshot_date
                FROM fct_orders o JOIN dim_customers c ON o.customer_id = c.customer_id) rd
          GROUP BY co.customer_unique_id, rd.snapshot_date))""",
}

REPORT = {
    "report_executive_kpis": f"""
      SELECT count(*) AS total_orders, count(DISTINCT customer_id) AS total_customers,
             CAST(sum(item_count) AS BIGINT) AS total_items,
             CAST(sum(payment_total) AS DECIMAL(16,2)) AS gross_payment_value,
             {exact_avg('payment_total', 2, 2, 14)} AS average_order_value,
             {exact_avg('average_review_score', 2, 2, 4)} AS average_review_score
      FROM fct_orders""",
    "report_daily_sales": """
      SELECT order_purchase_date, order_count, item_count, item_subtotal, freight_total, order_line_total,
             payment_total, average_review_score
      FROM mart_daily_sales ORDER BY order_purchase_date""",
    "report_delivery_performance": """
      SELECT order_purchase_date, order_count, delivered_order_count, late_delivery_count,
             CAST(100 * late_delivery_rate AS DECIMAL(8,2)) AS late_delivery_percentage,
             average_delivery_days, average_days_vs_estimate
      FROM mart_delivery_performance ORDER BY order_purchase_date""",
    "report_top_sellers": """
      SELECT seller_id, seller_city, seller_state, order_count, item_count, item_subtotal, freight_total,
             order_line_total, average_item_price, average_review_score
      FROM mart_seller_performance ORDER BY order_line_total DESC NULLS LAST, seller_id LIMIT 10""",
    "report_rfm_segments": f"""
      SELECT customer_segment, count(*) AS customer_count,
             CAST(sum(monetary_value) AS DECIMAL(16,2)) AS segment_value,
             {exact_avg('average_order_value', 2, 2, 14)} AS average_order_value
      FROM (SELECT monetary_value, average_order_value,
                   CASE WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'Champions'
                        WHEN recency_score >= 3 AND frequency_score >= 3 THEN 'Loyal customers'
                        WHEN recency_score >= 4 THEN 'Recent customers'
                        WHEN recency_score <= 2 AND frequency_score >= 3 THEN 'At risk'
                        ELSE 'Needs attention' END AS customer_segment
            FROM mart_customer_rfm)
      GROUP BY customer_segment ORDER BY segment_value DESC NULLS LAST, customer_segment""",
    "report_sales_by_state": f"""
      SELECT c.customer_state, count(*) AS order_count, count(DISTINCT o.customer_id) AS customer_count,
             CAST(sum(o.payment_total) AS DECIMAL(16,2)) AS gross_payment_value,
             {exact_avg('o.payment_total', 2, 2, 14)} AS average_order_value
      FROM fct_orders o JOIN dim_customers c ON o.customer_id = c.customer_id
      GROUP BY c.customer_state ORDER BY gross_payment_value DESC NULLS LAST, c.customer_state""",
}


def _ctes() -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = [
        ("geo", "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey"),
        ("li_amounts", """
          SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_returnflag,
                 CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
                 CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2))
                     AS freight
          FROM lineitem"""),
    ]
    for d in DATASETS:
        out.append((f"raw_{d.table_name}", RAW[d.table_name]))
    for d in DATASETS:
        out.append((f"bronze_{d.table_name}", _bronze(d.table_name, d.columns)))
    for name, sql in SILVER.items():
        out.append((f"silver_{name}", sql))
    for name, sql in GOLD.items():
        out.append((name, sql))
    for name, sql in MART.items():
        out.append((name, sql))
    for name, sql in REPORT.items():
        out.append((name, sql))
    return out


CTES = _ctes()


def with_ctes(select: str) -> str:
    body = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in CTES)
    return f"WITH {body}\n{select}"


def layer_query(name: str) -> str:
    return with_ctes(f"SELECT * FROM {name}")


def check_reports_sql() -> str:
    parts = [
        f"SELECT '{n}' AS report_name, count(*) AS row_count FROM {n}"
        for n in REPORT
    ]
    return with_ctes("\nUNION ALL\n".join(parts))


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def _check_sql(c) -> str:
    head = f"SELECT '{c.name}' AS check_name, '{c.table}' AS table_name, '{c.column}' AS column_name"
    col = c.column
    if c.kind == "not_null":
        return f"{head}, CAST(count(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS failing_rows FROM {c.table}"
    if c.kind == "unique":
        return (f"{head}, CAST(count(*) AS BIGINT) AS failing_rows FROM "
                f"(SELECT {col} FROM {c.table} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)")
    if c.kind == "relationships":
        return (f"{head}, CAST(count(*) AS BIGINT) AS failing_rows FROM {c.table} ch "
                f"WHERE ch.{col} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {c.to_table} pa WHERE pa.{c.to_column} = ch.{col})")
    if c.kind == "accepted_values":
        values = ", ".join(_lit(v) for v in c.values)
        return (f"{head}, CAST(count(DISTINCT {col}) FILTER (WHERE {col} NOT IN ({values})) AS BIGINT) "
                f"AS failing_rows FROM {c.table}")
    if c.kind == "non_negative":
        cond = " OR ".join(f"{x} < 0" for x in col.split(","))
        return f"{head}, CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS failing_rows FROM {c.table}"
    raise ValueError(c.kind)


def quality_suite_sql(suite) -> str:
    body = "\nUNION ALL\n".join(_check_sql(c) for c in suite)
    return with_ctes(f"SELECT *, failing_rows = 0 AS passed FROM (\n{body}\n)")


def replay_plan_sql() -> str:
    """Per purchase date, the row count of each landing table's daily slice,
    by direct (row-level) joins."""
    return with_ctes("""
    SELECT d.batch_date,
           CAST(d.n AS BIGINT) AS olist_orders_rows,
           CAST(coalesce(i.n, 0) AS BIGINT) AS olist_order_items_rows,
           CAST(coalesce(p.n, 0) AS BIGINT) AS olist_order_payments_rows,
           CAST(coalesce(r.n, 0) AS BIGINT) AS olist_order_reviews_rows,
           CAST(coalesce(c.n, 0) AS BIGINT) AS olist_customers_rows,
           CAST(coalesce(pr.n, 0) AS BIGINT) AS olist_products_rows,
           CAST(coalesce(s.n, 0) AS BIGINT) AS olist_sellers_rows,
           CAST(coalesce(g.n, 0) AS BIGINT) AS olist_geolocation_rows,
           CAST(coalesce(t.n, 0) AS BIGINT) AS product_category_name_translation_rows
    FROM (SELECT CAST(CAST(order_purchase_timestamp AS TIMESTAMP) AS DATE) AS batch_date, count(*) AS n
          FROM raw_olist_orders GROUP BY 1) d
    LEFT JOIN (SELECT x.batch_date, count(*) AS n FROM sl_orders x
               JOIN raw_olist_order_items y ON y.order_id IS NOT DISTINCT FROM x.order_id GROUP BY 1) i
           ON i.batch_date = d.batch_date
    LEFT JOIN (SELECT x.batch_date, count(*) AS n FROM sl_orders x
               JOIN raw_olist_order_payments y ON y.order_id IS NOT DISTINCT FROM x.order_id GROUP BY 1) p
           ON p.batch_date = d.batch_date
    LEFT JOIN (SELECT x.batch_date, count(*) AS n FROM sl_orders x
               JOIN raw_olist_order_reviews y ON y.order_id IS NOT DISTINCT FROM x.order_id GROUP BY 1) r
           ON r.batch_date = d.batch_date
    LEFT JOIN (SELECT x.batch_date, count(*) AS n FROM sl_customer_ids x
               JOIN raw_olist_customers y ON y.customer_id IS NOT DISTINCT FROM x.customer_id GROUP BY 1) c
           ON c.batch_date = d.batch_date
    LEFT JOIN (SELECT x.batch_date, count(*) AS n FROM sl_product_ids x
               JOIN raw_olist_products y ON y.product_id IS NOT DISTINCT FROM x.product_id GROUP BY 1) pr
           ON pr.batch_date = d.batch_date
    LEFT JOIN (SELECT x.batch_date, count(*) AS n FROM sl_seller_ids x
               JOIN raw_olist_sellers y ON y.seller_id IS NOT DISTINCT FROM x.seller_id GROUP BY 1) s
           ON s.batch_date = d.batch_date
    LEFT JOIN (SELECT x.batch_date, count(*) AS n FROM sl_zips x
               JOIN raw_olist_geolocation y ON y.geolocation_zip_code_prefix IS NOT DISTINCT FROM x.zip
               GROUP BY 1) g
           ON g.batch_date = d.batch_date
    LEFT JOIN (SELECT x.batch_date, count(*) AS n FROM sl_categories x
               JOIN raw_product_category_name_translation y
                 ON y.product_category_name IS NOT DISTINCT FROM x.product_category_name GROUP BY 1) t
           ON t.batch_date = d.batch_date""")


REPLAY_CTES = [
    ("sl_orders", """SELECT DISTINCT CAST(CAST(order_purchase_timestamp AS TIMESTAMP) AS DATE) AS batch_date, order_id
                     FROM raw_olist_orders"""),
    ("sl_customer_ids", """SELECT DISTINCT CAST(CAST(order_purchase_timestamp AS TIMESTAMP) AS DATE) AS batch_date,
                                  customer_id FROM raw_olist_orders"""),
    ("sl_product_ids", """SELECT DISTINCT x.batch_date, y.product_id FROM sl_orders x
                          JOIN raw_olist_order_items y ON y.order_id IS NOT DISTINCT FROM x.order_id"""),
    ("sl_seller_ids", """SELECT DISTINCT x.batch_date, y.seller_id FROM sl_orders x
                         JOIN raw_olist_order_items y ON y.order_id IS NOT DISTINCT FROM x.order_id"""),
    ("sl_categories", """SELECT DISTINCT x.batch_date, y.product_category_name FROM sl_product_ids x
                         JOIN raw_olist_products y ON y.product_id IS NOT DISTINCT FROM x.product_id"""),
    ("sl_zips", """SELECT DISTINCT x.batch_date, y.customer_zip_code_prefix AS zip FROM sl_customer_ids x
                   JOIN raw_olist_customers y ON y.customer_id IS NOT DISTINCT FROM x.customer_id
                   UNION
                   SELECT DISTINCT x.batch_date, y.seller_zip_code_prefix FROM sl_seller_ids x
                   JOIN raw_olist_sellers y ON y.seller_id IS NOT DISTINCT FROM x.seller_id"""),
]
CTES.extend(REPLAY_CTES)


def orders_summary_sql() -> str:
    return with_ctes("""
    SELECT count(*) AS orders,
           min(CAST(CAST(order_purchase_timestamp AS TIMESTAMP) AS DATE)) AS first_order_date,
           max(CAST(CAST(order_purchase_timestamp AS TIMESTAMP) AS DATE)) AS last_order_date
    FROM raw_olist_orders""")


def bronze_array_sql(table: str) -> str:
    """Bronze with the array row-hash layout: sha256 of the JSON array of the
    values, NULL read as ''."""
    cols = next(d.columns for d in DATASETS if d.table_name == table)
    arr = ", ".join(f"coalesce({c}, '')" for c in cols)
    return with_ctes(_bronze(table, cols).replace(
        f"sha256(to_json(struct_pack({', '.join(f'{c} := {c}' for c in cols)})))",
        f"sha256(to_json([{arr}]))"))


def _json_hash(cols: tuple[str, ...]) -> str:
    return f"sha256(to_json(struct_pack({', '.join(f'{c} := {c}' for c in cols)})))"


# Rows of the nine tables that belong to the first purchase date.
FIRST_DAY_SLICE = {
    "olist_orders": "SELECT * FROM raw_olist_orders WHERE CAST(CAST(order_purchase_timestamp AS TIMESTAMP) AS DATE) = (SELECT min(batch_date) FROM sl_orders)",
    "olist_order_items": "SELECT * FROM raw_olist_order_items WHERE order_id IN (SELECT order_id FROM fd_olist_orders)",
    "olist_order_payments": "SELECT * FROM raw_olist_order_payments WHERE order_id IN (SELECT order_id FROM fd_olist_orders)",
    "olist_order_reviews": "SELECT * FROM raw_olist_order_reviews WHERE order_id IN (SELECT order_id FROM fd_olist_orders)",
    "olist_customers": "SELECT * FROM raw_olist_customers WHERE customer_id IN (SELECT customer_id FROM fd_olist_orders)",
    "olist_products": "SELECT * FROM raw_olist_products WHERE product_id IN (SELECT product_id FROM fd_olist_order_items)",
    "olist_sellers": "SELECT * FROM raw_olist_sellers WHERE seller_id IN (SELECT seller_id FROM fd_olist_order_items)",
    "olist_geolocation": """SELECT * FROM raw_olist_geolocation WHERE geolocation_zip_code_prefix IN (
        SELECT customer_zip_code_prefix FROM fd_olist_customers UNION SELECT seller_zip_code_prefix FROM fd_olist_sellers)""",
    "product_category_name_translation": """SELECT * FROM raw_product_category_name_translation
        WHERE product_category_name IN (SELECT product_category_name FROM fd_olist_products)""",
}


def operator_queries_sql(suite) -> dict[str, str]:
    """SQL of the queries in ``plans.operator_queries``, from the landing rows."""
    cols = {d.table_name: d.columns for d in DATASETS}
    slice_ctes = ",\n".join(f"fd_{t} AS ({q})" for t, q in FIRST_DAY_SLICE.items())
    each = "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, {_json_hash(cols[t])} AS row_hash FROM fd_{t}" for t in FIRST_DAY_SLICE)
    sliced = with_ctes("").rstrip() + f",\n{slice_ctes},\nfd_rows AS ({each})\n"
    orders, customers = ", ".join(cols["olist_orders"]), ", ".join(cols["olist_customers"])
    o_hash, c_hash = _json_hash(cols["olist_orders"]), _json_hash(cols["olist_customers"])

    first_day = {t: f"CAST({k} AS BIGINT) % 2 = 0" for t, k in {
        "olist_orders": "order_id", "olist_order_items": "order_id", "olist_order_payments": "order_id", "olist_order_reviews": "review_id",
        "olist_customers": "customer_id", "olist_products": "product_id", "olist_sellers": "seller_id",
        "olist_geolocation": "geolocation_zip_code_prefix"}.items()} | {
        "product_category_name_translation": "length(product_category_name) % 2 = 0"}
    two_days = "\nUNION ALL\n".join(
        f"SELECT DISTINCT '{t}' AS table_name, {_json_hash(cols[t])} AS row_hash, "
        f"CASE WHEN {first} THEN DATE '2026-01-01' ELSE DATE '2026-01-02' END AS batch_date FROM raw_{t}" for t, first in first_day.items())
    loads = "\nUNION ALL\n".join(
        f"SELECT 'files' AS ledger, '{t}.read' AS state, count(*) + count(*) FILTER (WHERE {first}) AS rows FROM raw_{t}\n"
        f"UNION ALL SELECT 'files', '{t}.inserted', count(*) FROM (SELECT DISTINCT * FROM raw_{t})" for t, first in first_day.items())
    layers = [(f"silver.{n}", f"silver_{n}") for n in SILVER] + [(f"gold.{n}", n) for n in (*GOLD, *MART) if not n.endswith(("_iso", "_elapsed"))]
    orphans = "FROM silver_order_reviews WHERE order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM silver_orders WHERE order_id IS NOT NULL) GROUP BY order_id"
    return {
        "daily_slice_digest": sliced + "SELECT table_name, row_hash, count(*) AS copies FROM fd_rows GROUP BY ALL",
        "daily_batch_bronze": sliced + "SELECT DISTINCT table_name, row_hash, (SELECT min(batch_date) FROM sl_orders) AS batch_date FROM fd_rows",
        "scan_bronze": with_ctes(two_days),
        "ingest_ledgers": with_ctes(f"SELECT 'runs' AS ledger, 'succeeded' AS state, CAST(2 AS BIGINT) AS rows\nUNION ALL\n{loads}"),
        "streamed_bronze": with_ctes(two_days),
        "distinct_customers": with_ctes("\nUNION ALL\n".join(
            f"SELECT '{grain}' AS grain, {period} AS period, count(DISTINCT customer_id) AS customer_count FROM fct_orders GROUP BY 2"
            for grain, period in (("day", "order_purchase_date"), ("month", "CAST(date_trunc('month', order_purchase_date) AS DATE)"),
                                  ("year", "CAST(date_trunc('year', order_purchase_date) AS DATE)"), ("all", "CAST(NULL AS DATE)")))),
        "deduped_landings": with_ctes(f"SELECT DISTINCT {orders}, {o_hash} AS _row_hash, DATE '2026-01-01' AS _batch_date, 'b' AS _source_file FROM raw_olist_orders"),
        "inserted_rows": with_ctes(f"SELECT DISTINCT {customers}, {c_hash} AS _row_hash FROM raw_olist_customers WHERE CAST(customer_id AS BIGINT) % 2 <> 0"),
        "event_ntiles": """SELECT event_id, CAST(ntile(10) OVER (ORDER BY value NULLS FIRST, event_id) AS INTEGER) AS decile,
            CAST(6 - ntile(5) OVER (ORDER BY value NULLS FIRST, event_id) AS INTEGER) AS reversed_quintile FROM events""",
        "slice_zips": with_ctes("SELECT customer_zip_code_prefix AS zip FROM raw_olist_customers UNION SELECT seller_zip_code_prefix FROM raw_olist_sellers"),
        "failing_rows": with_ctes(f"""
            SELECT 'not_null' AS "check", review_id AS value, count(*) AS records FROM silver_order_reviews WHERE review_answered_at IS NULL GROUP BY review_id
            UNION ALL SELECT 'unique', customer_unique_id, count(*) FROM silver_customers WHERE customer_unique_id IS NOT NULL GROUP BY 2 HAVING count(*) > 1
            UNION ALL SELECT 'relationships', order_id, count(*) {orphans}
            UNION ALL SELECT 'orphan_keys', order_id, count(*) {orphans}
            UNION ALL SELECT 'accepted_values', order_status, count(*) FROM silver_orders WHERE order_status <> 'delivered' GROUP BY 2
            UNION ALL SELECT 'non_negative', order_id, count(*) FROM silver_order_items WHERE freight_value - 500 < 0 GROUP BY 2"""),
        "run_status_domain": with_ctes("""
            SELECT CASE order_status WHEN 'shipped' THEN 'paused' END AS status, count(*) AS n_records
            FROM raw_olist_orders WHERE order_status <> 'delivered' GROUP BY 1"""),
        "landing_inventory": sliced + "\nUNION ALL\n".join(
            f"SELECT '{d.filename}' AS filename, EXISTS (SELECT 1 FROM fd_{d.table_name}) AS present" for d in DATASETS),
        "stored_layer": layer_query("dim_customers"),
        "incremental_build": layer_query("mart_daily_sales"),
        "built_layers": with_ctes("\nUNION ALL\n".join(
            [f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {t}" for name, t in layers]
            + [f"SELECT 'check.' || check_name, failing_rows FROM ({_check_sql(c)})" for c in suite])),
    }
