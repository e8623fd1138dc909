"""Independent SQL statement of every registered query (DuckDB dialect).

The whole pipeline - drop derivation, NA tokens, coercions, file verdicts,
first-wins facts, last-wins dimensions, rollup - is restated once as a chain
of CTEs over the driver's tables, and each key adds its final SELECT.  It
shares no code with the Spark implementation: only the fixed values (NA
tokens, dirt rules, seed catalogue, limits) are common.
"""

from __future__ import annotations

from ..functions.cleaning import NA_TOKENS, NUMBER_PATTERN, INTEGER_PATTERN
from ..sources.sales_drop import REQUIRED_COLUMNS, SPLIT_FILE
from .quality import CHANNEL_DOMAIN, DATE_WINDOW, ORDER_ID_PATTERN, REGION_DOMAIN
from .warehouse import SEED_PRODUCTS


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_NA = ", ".join(_q(t) for t in NA_TOKENS)
_NUM = _q(NUMBER_PATTERN)
_INT = _q(INTEGER_PATTERN)
_SEED = ", ".join(f"({i}, {_q(n)}, {_q(c)}, {p})" for i, n, c, p in SEED_PRODUCTS)
_ARRIVAL = "source_file, a_ship, a_k, a_n, a_p, a_s"
_ARRIVAL_DESC = ", ".join(f"{c} DESC" for c in _ARRIVAL.split(", "))


def _na_select() -> str:
    return ",\n    ".join(f"CASE WHEN {c} IN ({_NA}) THEN NULL ELSE {c} END AS {c}_s" for c in REQUIRED_COLUMNS)


def _num(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}_s, {_NUM}) THEN TRY_CAST(trim({c}_s) AS DOUBLE) END"


BASE = f"""
WITH
sreg AS (
  SELECT s.s_suppkey, r.r_name
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
src AS (
  SELECT l.l_orderkey AS k, l.l_linenumber AS n, l.l_partkey, l.l_suppkey, l.l_shipdate,
         CAST(trunc(l.l_quantity) AS INTEGER) AS q,
         CAST(l.l_extendedprice AS DECIMAL(10,2)) AS p,
         CAST(round(l.l_discount * 100) AS DECIMAL(5,2)) AS d,
         o.o_orderpriority, c.c_name, pt.p_name, pt.p_type, sr.r_name,
         'raw/sales_' || strftime(l.l_shipdate, '%Y_%m') || '.csv' AS source_file
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part pt ON l.l_partkey = pt.p_partkey
  JOIN sreg sr ON l.l_suppkey = sr.s_suppkey
),
src2 AS (
  SELECT *, CAST(CAST(q AS DECIMAL(10,0)) * p * (CAST(100 AS DECIMAL(5,2)) - d)
                 * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS true_total
  FROM src
),
drop_ AS (
  SELECT
    CASE WHEN k % 101 = 7 THEN 'None' ELSE CAST(k AS VARCHAR) || '-' || CAST(n AS VARCHAR) END AS order_id,
    CASE WHEN k % 89 = 3 THEN 'not-a-date' WHEN k % 97 = 5 THEN ''
         ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS sale_date,
    c_name AS customer_name,
    CASE WHEN k % 83 = 11 THEN '' ELSE lower(c_name) || '@example.com' END AS customer_email,
    CASE WHEN k % 79 = 13 THEN 'NA' WHEN k % 5 = 0 THEN '  ' || r_name || ' ' ELSE r_name END AS region,
    CASE WHEN k % 73 = 17 THEN 'null' ELSE o_orderpriority END AS channel,
    CASE WHEN k % 12007 = 1 AND n = 7 THEN 'abc' ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
    p_name AS product_name,
    p_type AS category,
    CASE WHEN k % 17 = 0 THEN 'abc' WHEN k % 19 = 0 THEN '' WHEN k % 23 = 0 THEN CAST(q AS VARCHAR) || '.7'
         ELSE CAST(q AS VARCHAR) END AS quantity,
    CASE WHEN k % 41 = 0 THEN 'x' ELSE CAST(p AS VARCHAR) END AS unit_price,
    CASE WHEN k % 43 = 0 THEN '' ELSE CAST(CAST(d AS INTEGER) AS VARCHAR) END AS discount_pct,
    CAST(CASE WHEN k % 61 = 0 THEN true_total + 1 ELSE true_total END AS VARCHAR) AS total_amount,
    source_file, l_shipdate AS a_ship, k AS a_k, n AS a_n, l_partkey AS a_p, l_suppkey AS a_s
  FROM src2
),
na AS (
  SELECT
    {_na_select()},
    {_ARRIVAL}
  FROM drop_
),
num AS (
  SELECT *,
    {_num('quantity')} AS q_num,
    {_num('product_id')} AS pid_num,
    {_num('unit_price')} AS price_num,
    {_num('discount_pct')} AS disc_num,
    {_num('total_amount')} AS tot_num,
    CAST(TRY_STRPTIME(sale_date_s, '%Y-%m-%d') AS DATE) AS d0
  FROM na
),
typed AS (
  SELECT
    order_id_s AS order_id,
    CASE WHEN d0 BETWEEN DATE '1677-09-22' AND DATE '2262-04-11' THEN d0 END AS sale_date,
    coalesce(customer_name_s, 'NaN') AS customer_name,
    coalesce(customer_email_s, 'NaN') AS email,
    coalesce(regexp_replace(region_s, '^\\s+|\\s+$', '', 'g'), 'Unknown') AS region,
    coalesce(regexp_replace(channel_s, '^\\s+|\\s+$', '', 'g'), 'Unknown') AS channel,
    CASE WHEN trunc(pid_num) BETWEEN -2147483648 AND 2147483647 THEN CAST(trunc(pid_num) AS INTEGER) END AS product_id,
    coalesce(product_name_s, 'NaN') AS product_name,
    coalesce(category_s, 'NaN') AS category,
    CASE WHEN trunc(coalesce(q_num, 1)) BETWEEN -2147483648 AND 2147483647
         THEN CAST(trunc(coalesce(q_num, 1)) AS INTEGER) END AS quantity,
    CASE WHEN price_num IS NULL THEN CAST(0 AS DECIMAL(10,2)) ELSE TRY_CAST(trim(unit_price_s) AS DECIMAL(10,2)) END AS unit_price,
    CASE WHEN disc_num IS NULL THEN CAST(0 AS DECIMAL(5,2)) ELSE TRY_CAST(trim(discount_pct_s) AS DECIMAL(5,2)) END AS discount,
    CASE WHEN total_amount_s IS NULL THEN NULL WHEN tot_num IS NULL THEN CAST(0 AS DECIMAL(12,2))
         ELSE TRY_CAST(trim(total_amount_s) AS DECIMAL(12,2)) END AS claimed_total,
    {_ARRIVAL},
    (order_id_s IS NOT NULL AND sale_date_s IS NOT NULL AND product_id_s IS NOT NULL) AS c4,
    coalesce(isinf(q_num), false) AS q_inf,
    (product_id_s IS NOT NULL AND pid_num IS NULL) AS pid_text,
    (pid_num IS NOT NULL AND NOT regexp_matches(product_id_s, {_INT})) AS pid_fraction,
    (price_num IS NOT NULL AND TRY_CAST(trim(unit_price_s) AS DECIMAL(10,2)) IS NULL) AS price_over,
    (disc_num IS NOT NULL AND TRY_CAST(trim(discount_pct_s) AS DECIMAL(5,2)) IS NULL) AS disc_over,
    (region_s IS NULL OR {_num('region')} IS NOT NULL) AS region_untyped,
    (channel_s IS NULL OR {_num('channel')} IS NOT NULL) AS channel_untyped
  FROM num
),
typed2 AS (
  SELECT *,
    TRY_CAST(CAST(quantity AS DECIMAL(10,0)) * unit_price * (CAST(100 AS DECIMAL(5,2)) - discount)
             * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS total_amount,
    c4 AND sale_date IS NOT NULL AS c5
  FROM typed
),
flags AS (
  SELECT *,
    (c4 AND q_inf) OR (c5 AND (pid_text OR product_id IS NULL OR quantity IS NULL OR price_over
      OR disc_over OR total_amount IS NULL OR length(order_id) > 50 OR length(customer_name) > 255
      OR length(email) > 255 OR length(region) > 100 OR length(channel) > 50
      OR length(product_name) > 255 OR length(category) > 100 OR length(source_file) > 255)) AS row_err
  FROM typed2
),
verdict AS (
  SELECT source_file,
    CASE WHEN bool_or(row_err) OR bool_and(region_untyped) OR bool_and(channel_untyped)
              OR (bool_or(pid_text) AND bool_or(c5 AND pid_fraction))
         THEN 'error' ELSE 'success' END AS status,
    COUNT(*) AS n_records,
    COUNT(*) FILTER (WHERE c5) AS n_candidates
  FROM flags GROUP BY source_file
),
good AS (
  SELECT f.* FROM flags f JOIN verdict v USING (source_file)
  WHERE v.status = 'success' AND f.c5
),
fact AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {_ARRIVAL}) AS rn FROM good
  ) WHERE rn = 1
),
cust AS (
  SELECT email, customer_name, region FROM (
    SELECT email, customer_name, region,
           row_number() OVER (PARTITION BY email ORDER BY {_ARRIVAL_DESC}) AS rn FROM good
  ) WHERE rn = 1
),
seed(product_id, product_name, category, unit_price) AS (VALUES {_SEED}),
prod_new AS (
  SELECT product_id, product_name, category, unit_price FROM (
    SELECT product_id, product_name, category, unit_price,
           row_number() OVER (PARTITION BY product_id ORDER BY {_ARRIVAL_DESC}) AS rn FROM good
  ) WHERE rn = 1
),
prod AS (
  SELECT * FROM prod_new
  UNION ALL
  SELECT s.product_id, s.product_name, s.category, CAST(s.unit_price AS DECIMAL(10,2))
  FROM seed s WHERE s.product_id NOT IN (SELECT product_id FROM prod_new)
),
mv AS (
  SELECT CAST(date_trunc('month', f.sale_date) AS DATE) AS month, f.region, f.channel, pr.category,
         COUNT(*) AS total_orders, CAST(SUM(f.quantity) AS BIGINT) AS total_units,
         SUM(f.total_amount) AS rev
  FROM fact f JOIN prod pr ON f.product_id = pr.product_id
  GROUP BY 1, 2, 3, 4
),
runs AS (
  SELECT v.source_file, v.status,
         CAST(CASE WHEN v.status = 'success' THEN coalesce(l.n, 0) ELSE 0 END AS INTEGER) AS rows_loaded
  FROM verdict v LEFT JOIN (SELECT source_file, COUNT(*) AS n FROM fact GROUP BY source_file) l
    USING (source_file)
),
vpp AS (
  SELECT pr.product_id, pr.product_name, pr.category,
         COUNT(f.order_id) AS total_orders,
         CAST(SUM(f.quantity) AS BIGINT) AS total_units_sold,
         CAST(SUM(f.total_amount) AS DOUBLE) AS total_revenue,
         CASE WHEN COUNT(f.unit_price) > 0 THEN CAST(SUM(f.unit_price) AS DOUBLE) / COUNT(f.unit_price) END AS avg_selling_price,
         CASE WHEN COUNT(f.discount) > 0 THEN CAST(SUM(f.discount) AS DOUBLE) / COUNT(f.discount) END AS avg_discount_pct
  FROM prod pr LEFT JOIN fact f ON f.product_id = pr.product_id
  GROUP BY pr.product_id, pr.product_name, pr.category
)
"""

_MV = ("SELECT month, region, channel, category, total_orders, total_units, "
       "CAST(rev AS DOUBLE) AS total_revenue, CAST(rev AS DOUBLE) / total_orders AS avg_order_value FROM mv")
_REV = "CAST(SUM(total_amount) AS DOUBLE) AS revenue"
_AVG = "CAST(SUM(total_amount) AS DOUBLE) / COUNT(total_amount) AS avg_order_value"


def _null_counts() -> str:
    never_null = {"sale_id", "customer_id", "processed_at"}
    cols = ["sale_id", "order_id", "sale_date", "customer_id", "product_id", "quantity", "unit_price",
            "discount", "total_amount", "region", "channel", "processed_at", "source_file", "sale_month"]
    parts = []
    for c in cols:
        if c in never_null:
            parts.append(f"CAST(0 AS BIGINT) AS null_{c}")
        elif c == "sale_month":
            parts.append(f"COUNT(*) FILTER (WHERE sale_date IS NULL) AS null_{c}")
        else:
            parts.append(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_{c}")
    return "SELECT " + ", ".join(parts) + " FROM fact"


def _in(values) -> str:
    return ", ".join(_q(v) for v in values)


FINAL = {
    "mv_monthly_sales": _MV,
    "mv_refresh_full": _MV,
    "mv_refresh_incremental": _MV,
    "v_product_performance": ("SELECT product_name, category, total_orders, total_units_sold, total_revenue, "
                              "avg_selling_price, avg_discount_pct FROM vpp"),
    "v_regional_performance": ("SELECT region, COUNT(DISTINCT email) AS unique_customers, COUNT(*) AS total_orders, "
                               f"CAST(SUM(total_amount) AS DOUBLE) AS total_revenue, {_AVG} FROM fact GROUP BY region"),
    "bi_monthly_revenue_trend": "SELECT month, CAST(SUM(rev) AS DOUBLE) AS revenue FROM mv GROUP BY month ORDER BY month",
    "bi_revenue_by_region": ("SELECT region, CAST(SUM(total_amount) AS DOUBLE) AS total_revenue, "
                             "COUNT(DISTINCT email) AS unique_customers FROM fact GROUP BY region "
                             "ORDER BY total_revenue DESC NULLS FIRST"),
    "bi_top10_products": ("SELECT product_name, category, total_revenue, total_units_sold FROM vpp "
                          "ORDER BY total_revenue DESC NULLS FIRST, product_id LIMIT 10"),
    "bi_top10_products_sold": ("SELECT product_name, category, total_revenue, total_units_sold FROM vpp "
                               "WHERE total_revenue IS NOT NULL "
                               "ORDER BY total_revenue DESC NULLS FIRST, product_id LIMIT 10"),
    "bi_sales_channel_breakdown": f"SELECT channel, COUNT(*) AS orders, {_REV} FROM fact GROUP BY channel ORDER BY revenue DESC NULLS FIRST",
    "bi_category_revenue_by_month": ("SELECT month, category, CAST(SUM(rev) AS DOUBLE) AS revenue FROM mv "
                                     "GROUP BY month, category ORDER BY month, revenue DESC NULLS FIRST"),
    "dash_kpis": ("SELECT CAST(SUM(total_amount) AS DOUBLE) AS total_revenue, COUNT(*) AS total_orders, "
                  "COUNT(DISTINCT email) AS total_customers FROM fact"),
    "dash_order_volume": ("SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month, COUNT(*) AS orders "
                          "FROM fact GROUP BY 1 ORDER BY 1"),
    "dash_quarterly": (f"SELECT CAST(date_trunc('quarter', sale_date) AS DATE) AS quarter, COUNT(*) AS orders, {_REV} "
                       "FROM fact GROUP BY 1 ORDER BY 1"),
    "dash_category_breakdown": ("SELECT pr.category, COUNT(*) AS orders, CAST(SUM(f.quantity) AS BIGINT) AS units, "
                                "CAST(SUM(f.total_amount) AS DOUBLE) AS revenue "
                                "FROM fact f JOIN prod pr ON f.product_id = pr.product_id GROUP BY pr.category"),
    "dash_discount_impact": (f"SELECT CAST(discount AS DOUBLE) AS discount, COUNT(*) AS orders, {_REV}, {_AVG} "
                             "FROM fact GROUP BY 1 ORDER BY 1"),
    "dash_region_channel": f"SELECT region, channel, COUNT(*) AS orders, {_REV} FROM fact GROUP BY region, channel",
    "dash_region_channel_pivot": ("SELECT region, " + ", ".join(
        f"CAST(SUM(total_amount) FILTER (WHERE channel = {_q(c)}) AS DOUBLE) AS channel_{i}" for i, c in enumerate(CHANNEL_DOMAIN, 1))
        + f", CAST(SUM(total_amount) FILTER (WHERE channel IS NULL OR channel NOT IN ({_in(CHANNEL_DOMAIN)})) AS DOUBLE) AS channel_other "
          "FROM fact GROUP BY region"),
    "dash_region_monthly_customers": ("SELECT m.*, t.region_customers FROM (SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month, region, "
                                      "COUNT(DISTINCT email) AS customers FROM fact GROUP BY 1, 2) m "
                                      "JOIN (SELECT region, COUNT(DISTINCT email) AS region_customers FROM fact GROUP BY region) t "
                                      "ON m.region IS NOT DISTINCT FROM t.region"),
    "dash_region_monthly": (f"SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month, region, COUNT(*) AS orders, "
                            f"{_REV} FROM fact GROUP BY 1, 2"),
    "dash_region_quarterly": (f"SELECT CAST(date_trunc('quarter', sale_date) AS DATE) AS quarter, region, "
                              f"COUNT(*) AS orders, {_REV} FROM fact GROUP BY 1, 2"),
    "dash_freshness": ("SELECT MAX(sale_date) AS latest_sale_date, (SELECT MAX(month) FROM mv) AS latest_rollup_month "
                       "FROM fact"),
    "dash_error_monitor": ("SELECT status, COUNT(*) AS files, CAST(SUM(rows_loaded) AS BIGINT) AS rows_loaded "
                           "FROM runs GROUP BY status"),
    # the messages that the drop's dirt rules can cause
    "dash_error_files": ("SELECT source_file, v.status, CASE WHEN bool_or(pid_text) AND bool_or(c5 AND pid_fraction) THEN 'product_id is not an integer' "
                         "WHEN bool_or(c5 AND pid_text) THEN 'product_id is not a number' END AS error_message "
                         "FROM verdict v JOIN flags f USING (source_file) WHERE v.status <> 'success' GROUP BY 1, 2"),
    "sales_core": ("SELECT f.order_id, f.sale_date, c.customer_name, f.email, c.region AS customer_region, "
                   "pr.product_name, pr.category, f.quantity, CAST(f.total_amount AS DOUBLE) AS total_amount, "
                   "f.region, f.channel FROM fact f JOIN cust c ON f.email = c.email "
                   "JOIN prod pr ON f.product_id = pr.product_id"),
    "rows_loaded_per_file": "SELECT source_file, CAST(rows_loaded AS BIGINT) AS rows_loaded FROM runs",
    "insert_ignore_fact_sales": ("SELECT order_id, sale_date, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, "
                                 "CAST(discount AS DOUBLE) AS discount, CAST(total_amount AS DOUBLE) AS total_amount, "
                                 "region, channel, source_file FROM fact"),
    "upsert_dim_customers": "SELECT email, customer_name, region FROM cust",
    "upsert_dim_products": ("SELECT product_id, product_name, category, CAST(unit_price AS DOUBLE) AS unit_price "
                            "FROM prod"),
    "replay_idempotence": "SELECT source_file, status, CAST(0 AS INTEGER) AS rows_loaded FROM verdict",
    "seed_products": ("SELECT s.product_id, s.product_name AS seed_name, s.category AS seed_category, "
                      "CAST(s.unit_price AS DOUBLE) AS seed_price, pr.product_name AS current_name, "
                      "pr.category AS current_category, CAST(pr.unit_price AS DOUBLE) AS current_price, "
                      "NOT (pr.product_name IS NOT DISTINCT FROM s.product_name "
                      "AND pr.category IS NOT DISTINCT FROM s.category "
                      "AND CAST(pr.unit_price AS DOUBLE) IS NOT DISTINCT FROM CAST(s.unit_price AS DOUBLE)) AS overwritten "
                      "FROM seed s LEFT JOIN prod pr ON s.product_id = pr.product_id"),
    "resolve_customer_id": ("SELECT f.order_id, f.email, c.customer_name FROM fact f "
                            "JOIN cust c ON f.email = c.email"),
    "surrogate_keys": ("SELECT 'dim_customers' AS table_name, COUNT(*) AS n_rows, COUNT(*) AS n_ids, "
                       "COUNT(DISTINCT email) AS n_keys, CAST(1 AS BIGINT) AS min_id, COUNT(*) AS max_id FROM cust "
                       "UNION ALL SELECT 'fact_sales', COUNT(*), COUNT(*), COUNT(DISTINCT order_id), "
                       "CAST(1 AS BIGINT), COUNT(*) FROM fact "
                       "UNION ALL SELECT 'pipeline_runs', COUNT(*), COUNT(*), COUNT(DISTINCT source_file), "
                       "CAST(1 AS BIGINT), COUNT(*) FROM verdict"),
    "source_file_lineage": ("SELECT source_file, CAST(date_trunc('month', sale_date) AS DATE) AS sale_month, "
                            "COUNT(*) AS facts FROM fact GROUP BY 1, 2"),
    "generated_total_amount": ("SELECT order_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, "
                               "CAST(discount AS DOUBLE) AS discount, CAST(total_amount AS DOUBLE) AS total_amount "
                               "FROM fact"),
    "fact_projection": "SELECT order_id, email, CAST(discount AS DOUBLE) AS discount, source_file FROM good",
    "file_atomic_load": "SELECT source_file, status, n_records, n_candidates FROM verdict",
    "pipeline_runs_log": "SELECT source_file, rows_loaded, status FROM runs",
    "runs_success_count": "SELECT COUNT(*) AS success_runs FROM verdict WHERE status = 'success'",
    "refresh_needed": "SELECT coalesce(bool_or(status = 'success'), false) AS refresh_needed FROM verdict",
    "archive_plan": ("SELECT source_file, replace(source_file, 'raw/', 'archive/') AS archive_key, "
                     "n_records AS rows FROM verdict WHERE status = 'success'"),
    "unprocessed_files": "SELECT source_file FROM verdict WHERE status <> 'success'",
    "clean_na_tokens": "SELECT " + ", ".join(
        f"COUNT(*) FILTER (WHERE {c} IS NULL OR {c} IN ({_NA})) AS na_{c}" for c in REQUIRED_COLUMNS) + " FROM drop_",
    "clean_drop_null_keys": ("SELECT source_file, COUNT(*) AS n_records, COUNT(*) FILTER (WHERE c4) AS n_kept, "
                             "COUNT(*) FILTER (WHERE NOT c4) AS n_dropped FROM flags GROUP BY source_file"),
    "clean_bad_dates": ("SELECT source_file, COUNT(*) FILTER (WHERE c4 AND NOT c5) AS n_bad_dates "
                        "FROM flags GROUP BY source_file"),
    "clean_numeric_coercion": ("SELECT source_file, order_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, "
                               "CAST(discount AS DOUBLE) AS discount FROM flags WHERE c5"),
    "clean_trim_fill": "SELECT region, channel, COUNT(*) AS n FROM flags WHERE c5 GROUP BY region, channel",
    "clean_missing_email": ("SELECT (SELECT COUNT(*) FROM good WHERE email = 'NaN') AS missing_email_rows, "
                            "customer_name AS merged_customer_name, region AS merged_customer_region "
                            "FROM cust WHERE email = 'NaN'"),
    "dq_table_counts": ("SELECT (SELECT COUNT(*) FROM fact) AS fact_sales, (SELECT COUNT(*) FROM cust) AS dim_customers, "
                        "(SELECT COUNT(*) FROM prod) AS dim_products, "
                        "(SELECT COUNT(*) FROM verdict WHERE status = 'success') AS success_runs, "
                        "(SELECT COUNT(*) FROM mv) AS mv_monthly_sales"),
    "dq_null_order_ids": "SELECT COUNT(*) FILTER (WHERE order_id IS NULL) AS null_order_ids FROM fact",
    "dq_negative_amounts": "SELECT COUNT(*) FILTER (WHERE total_amount < 0) AS negative_amounts FROM fact",
    "dq_orphan_customers": ("SELECT COUNT(*) AS orphan_customers FROM fact f LEFT JOIN cust c ON f.email = c.email "
                            "WHERE c.email IS NULL"),
    "dq_orphan_products": ("SELECT COUNT(*) AS orphan_products FROM fact f LEFT JOIN prod pr "
                           "ON f.product_id = pr.product_id WHERE pr.product_id IS NULL"),
    "dq_duplicate_order_ids": ("SELECT COUNT(*) AS duplicate_order_ids FROM "
                               "(SELECT order_id FROM fact GROUP BY order_id HAVING COUNT(*) > 1) dupes"),
    "dq_null_counts": _null_counts(),
    "dq_order_id_format": (f"SELECT COUNT(*) FILTER (WHERE regexp_matches(order_id, {_q(ORDER_ID_PATTERN)})) AS well_formed, "
                           f"COUNT(*) FILTER (WHERE NOT regexp_matches(order_id, {_q(ORDER_ID_PATTERN)})) AS malformed "
                           "FROM fact"),
    "dq_domain_violations": (f"SELECT COUNT(*) FILTER (WHERE region NOT IN ({_in(REGION_DOMAIN)})) AS bad_region, "
                             f"COUNT(*) FILTER (WHERE channel NOT IN ({_in(CHANNEL_DOMAIN)})) AS bad_channel FROM fact"),
    "dq_range_violations": ("SELECT COUNT(*) FILTER (WHERE quantity <= 0) AS nonpositive_quantity, "
                            "COUNT(*) FILTER (WHERE unit_price <= 0) AS nonpositive_price, "
                            "COUNT(*) FILTER (WHERE NOT (discount BETWEEN 0 AND 100)) AS discount_out_of_range, "
                            f"COUNT(*) FILTER (WHERE NOT (sale_date BETWEEN DATE {_q(DATE_WINDOW[0])} "
                            f"AND DATE {_q(DATE_WINDOW[1])})) AS date_out_of_window FROM fact"),
    "dq_catalogue": ("SELECT COUNT(*) AS products, COUNT(*) FILTER (WHERE unit_price <= 0) AS nonpositive_price, "
                     "COUNT(*) FILTER (WHERE category IS NULL OR category = 'NaN') AS missing_category, "
                     "(SELECT COUNT(*) FROM (SELECT product_id FROM prod GROUP BY product_id HAVING COUNT(*) > 1)) "
                     "AS duplicate_ids FROM prod"),
    "dq_total_mismatch": ("SELECT order_id, source_file, CAST(claimed_total AS DOUBLE) AS claimed_total, "
                          "CAST(total_amount AS DOUBLE) AS total_amount FROM good "
                          "WHERE abs(claimed_total - total_amount) > 0.01"),
    "dq_cross_batch_overlap": (f"SELECT order_id FROM good WHERE source_file < {_q(SPLIT_FILE)} "
                               f"INTERSECT SELECT order_id FROM good WHERE source_file >= {_q(SPLIT_FILE)}"),
    "dq_summary": (
        "SELECT 'required_tables' AS check_name, CAST(4 AS BIGINT) AS observed, true AS passed "
        "UNION ALL SELECT 'views_present', 3, true "
        "UNION ALL SELECT 'products_seeded', COUNT(*), COUNT(*) >= 14 FROM prod "
        "UNION ALL SELECT 'fact_rows', COUNT(*), COUNT(*) > 0 FROM fact "
        "UNION ALL SELECT 'success_runs', COUNT(*), COUNT(*) > 0 FROM verdict WHERE status = 'success' "
        "UNION ALL SELECT 'rollup_rows', COUNT(*), COUNT(*) > 0 FROM mv "
        "UNION ALL SELECT 'null_order_ids', COUNT(*), COUNT(*) = 0 FROM fact WHERE order_id IS NULL "
        "UNION ALL SELECT 'negative_amounts', COUNT(*), COUNT(*) = 0 FROM fact WHERE total_amount < 0 "
        "UNION ALL SELECT 'orphan_customers', COUNT(*), COUNT(*) = 0 FROM fact f "
        "LEFT JOIN cust c ON f.email = c.email WHERE c.email IS NULL "
        "UNION ALL SELECT 'orphan_products', COUNT(*), COUNT(*) = 0 FROM fact f "
        "LEFT JOIN prod pr ON f.product_id = pr.product_id WHERE pr.product_id IS NULL "
        "UNION ALL SELECT 'duplicate_order_ids', COUNT(*), COUNT(*) = 0 FROM "
        "(SELECT order_id FROM fact GROUP BY order_id HAVING COUNT(*) > 1) d"),
}


_AS_READ = ", ".join(f"NULLIF({c}, '') AS {c}" for c in REQUIRED_COLUMNS)
# month number of a drop file name raw/sales_YYYY_MM.csv
_MONTH = "CAST(substr(source_file, 16, 2) AS INTEGER)"
_FOLDER = "'raw/part=' || substr(source_file, 11, 7)"
FINAL.update({
    # the CSV drop written from the derived drop and read back by name
    "csv_scan": f"SELECT {_AS_READ} FROM drop_",
    # the messy drop: months 1, 6, 11 lack a column, month 7 has ragged records
    "csv_union_by_name": f"SELECT {_AS_READ} FROM drop_ WHERE {_MONTH} NOT IN (1, 6, 7, 11)",
    "csv_roundtrip": ("SELECT COUNT(*) AS written, COUNT(*) AS read, CAST(0 AS BIGINT) AS only_written, "
                      "CAST(0 AS BIGINT) AS only_read FROM drop_"),
    # structural checks per drop folder (raw/part=YYYY_MM, plus raw/empty with
    # one header-only file)
    "validate_required_columns": (
        f"SELECT DISTINCT {_FOLDER} AS folder, "
        f"CASE WHEN {_MONTH} IN (1, 6, 11) THEN 'channel' ELSE '' END AS missing_columns, "
        f"{_MONTH} NOT IN (1, 6, 11) AS has_required_columns FROM drop_ "
        "UNION ALL SELECT 'raw/empty', '', true"),
    "validate_non_empty": (
        f"SELECT {_FOLDER} AS folder, COUNT(*) AS n_records, true AS non_empty FROM drop_ GROUP BY 1 "
        "UNION ALL SELECT 'raw/empty', CAST(0 AS BIGINT), false"),
    # rollup stored after the first of two runs vs the live rollup: a month's
    # revenue is the sum over its facts whatever the category mapping
    "mv_staleness": (
        "SELECT COALESCE(s.month, l.month) AS month, s.stored_revenue, l.live_revenue, "
        "s.stored_revenue IS DISTINCT FROM l.live_revenue AS stale FROM "
        "(SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month, "
        f"CAST(SUM(total_amount) AS DOUBLE) AS stored_revenue FROM fact WHERE source_file < {_q(SPLIT_FILE)} "
        "GROUP BY 1) s FULL OUTER JOIN "
        "(SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month, "
        "CAST(SUM(total_amount) AS DOUBLE) AS live_revenue FROM fact GROUP BY 1) l ON s.month = l.month"),
    "validate_ragged": (
        f"SELECT {_FOLDER} AS folder, bool_or({_MONTH} = 7 AND a_n = 1) AS ragged FROM drop_ GROUP BY 1 "
        "UNION ALL SELECT 'raw/empty', false"),
})


def oracle_sql() -> dict[str, str]:
    return {k: BASE + v for k, v in FINAL.items()}
