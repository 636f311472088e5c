"""DuckDB text of the retail model, used by the SQL oracle in ``__spark_entry__``.

Mirrors :mod:`strata.sources.retail` and the silver / gold rules, written
independently in plain SQL so the two engines check each other.
"""

from __future__ import annotations

from strata.config import Config

_C = Config()

# Fixed values (must equal strata.sources.retail and strata.config):
RUN_TS = f"TIMESTAMP '{_C.run_ts}'"
INITIAL_TS = f"TIMESTAMP '{_C.initial_ts}'"
INCR_TS = f"TIMESTAMP '{_C.incremental_ts}'"

ENTITY_CTES = f"""
s_customers AS (
  SELECT CAST(c_custkey AS BIGINT) AS customer_id, c_name AS name, n_name || '-' || c_mktsegment AS city,
         n_name AS state, CAST(created AS DATE) AS signup_date, created AS created_at,
         CASE WHEN c_custkey % 7 = 0 THEN created + INTERVAL 400 DAY END AS updated_at
  FROM (SELECT *, TIMESTAMP '1994-01-01 00:00:00' + to_days(CAST(c_custkey * 7 % 2500 AS INTEGER)) AS created
        FROM customer) x
  JOIN nation ON c_nationkey = n_nationkey
),
s_products AS (
  SELECT CAST(p_partkey AS BIGINT) AS product_id, p_name AS product_name, p_brand AS category,
         CAST(p_retailprice AS DECIMAL(12,2)) AS price, created AS created_at,
         CASE WHEN p_size > 40 THEN created + INTERVAL 300 DAY END AS updated_at
  FROM (SELECT *, TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(p_partkey * 3 % 2000 AS INTEGER)) AS created
        FROM part) x
),
s_orders AS (
  SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_custkey AS BIGINT) AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date, CAST(o_totalprice AS DECIMAL(14,2)) AS total_amount,
         o_orderstatus AS order_status, o_orderdate AS created_at,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY END AS updated_at
  FROM orders
),
s_order_items AS (
  SELECT CAST(l_orderkey * 100 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
              l_suppkey, l_shipdate, l_extendedprice, l_quantity) AS BIGINT) AS order_item_id,
         CAST(l_orderkey AS BIGINT) AS order_id, CAST(l_partkey AS BIGINT) AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         l_shipdate AS created_at,
         CASE WHEN l_returnflag = 'R' THEN l_shipdate + INTERVAL 60 DAY END AS updated_at
  FROM lineitem
)"""

# silver tables of the full run
SILVER_CTES = ENTITY_CTES + f""",
sv_customers AS (SELECT *, {RUN_TS} AS record_created_at, CAST(NULL AS TIMESTAMP) AS record_updated_at FROM s_customers),
sv_products AS (SELECT *, {RUN_TS} AS record_created_at, CAST(NULL AS TIMESTAMP) AS record_updated_at FROM s_products),
sv_orders AS (SELECT *, {RUN_TS} AS record_created_at, CAST(NULL AS TIMESTAMP) AS record_updated_at FROM s_orders),
sv_order_items AS (SELECT *, {RUN_TS} AS record_created_at, CAST(NULL AS TIMESTAMP) AS record_updated_at
                   FROM s_order_items)"""

GOLD_CTES = SILVER_CTES + """,
dim_customers AS (
  SELECT customer_id, name AS customer_name, city, state, signup_date, created_at, updated_at,
         record_created_at, record_updated_at FROM sv_customers),
dim_products AS (
  SELECT product_id, product_name, category, price, created_at, updated_at, record_created_at, record_updated_at
  FROM sv_products),
fact_sales AS (
  SELECT oi.order_item_id AS sales_id, o.order_id, o.customer_id, oi.product_id, o.order_date AS sales_date,
         oi.quantity, oi.price AS unit_price, oi.quantity * oi.price AS line_total, o.total_amount AS order_total,
         o.order_status, o.created_at, o.updated_at, o.record_created_at, o.record_updated_at
  FROM sv_orders o JOIN sv_order_items oi ON o.order_id = oi.order_id)"""

FACT_COLS = ("sales_id, order_id, customer_id, product_id, sales_date, quantity, "
             "CAST(unit_price AS DOUBLE) AS unit_price, CAST(line_total AS DOUBLE) AS line_total, "
             "CAST(order_total AS DOUBLE) AS order_total, order_status, created_at, updated_at, "
             "record_created_at, record_updated_at")


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"
