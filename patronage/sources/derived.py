"""The four customer-facing tables, derived from the order and event tables.

The texts run unchanged in Spark and, for the checks, in DuckDB. ``{name}``
stands for a source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from patronage.schemas import conform

CRM_CUSTOMERS_SQL = """
WITH base AS (
  SELECT c.c_custkey AS k, concat(p.p_name, ' ', right(c.c_name, 3)) AS nm,
         concat('user', CAST(c.c_custkey AS STRING), '@test.com') AS em,
         CAST(2015550000 + c.c_custkey * 7919 AS STRING) AS ph,
         c.c_mktsegment AS segment, n.n_name AS address
  FROM {customer} c JOIN {part} p ON p.p_partkey = c.c_custkey
  JOIN {nation} n ON n.n_nationkey = c.c_nationkey),
raw AS (
  SELECT k, nm, segment, address,
    CASE WHEN k % 10 = 0 THEN NULL WHEN k % 20 = 3 THEN upper(em)
         WHEN k % 20 = 7 THEN replace(em, '@', ' @ ') ELSE em END AS email,
    CASE WHEN k % 25 < 2 THEN NULL
         WHEN k % 4 = 0 THEN concat(substr(ph,1,3),'-',substr(ph,4,3),'-',substr(ph,7,4))
         WHEN k % 4 = 1 THEN concat('(',substr(ph,1,3),') ',substr(ph,4,3),'-',substr(ph,7,4))
         WHEN k % 4 = 2 THEN ph
         ELSE concat('+1-',substr(ph,1,3),'-',substr(ph,4,3),'-',substr(ph,7,4)) END AS phone,
    ph,
    DATE '1995-01-01' + CAST((k * 37) % 1000 AS INT) AS signup_date,
    CAST(10000 + (k * 37) % 100 AS STRING) AS zip_code
  FROM base)
SELECT k AS rec_id, concat('CRM_', lpad(CAST(k AS STRING), 6, '0')) AS customer_id, nm AS name,
       email, phone, signup_date, segment, address, zip_code FROM raw
UNION ALL
SELECT 1000000 + k, concat('CRM_DUP_', lpad(CAST(k AS STRING), 6, '0')),
       CASE WHEN k % 3 = 0 THEN upper(nm) WHEN k % 3 = 1 THEN concat(nm, ' Jr.') ELSE replace(nm, 'e', '') END,
       email, CASE WHEN phone IS NULL THEN NULL ELSE ph END, signup_date, segment, address, zip_code
FROM raw WHERE k % 20 = 5 OR k % 100 = 20
"""

TRANSACTIONS_SQL = """
SELECT concat('TXN_', lpad(CAST(o_orderkey AS STRING), 8, '0')) AS transaction_id,
       CASE WHEN o_orderkey % 20 = 7 THEN concat('ORPHAN_', lpad(CAST(o_custkey AS STRING), 6, '0'))
            ELSE concat('CRM_', lpad(CAST(o_custkey AS STRING), 6, '0')) END AS customer_id,
       CAST(o_orderdate AS DATE) AS date, o_totalprice AS amount, o_orderpriority AS product_category
FROM {orders}
"""

WEB_SESSIONS_SQL = """
SELECT concat('SES_', lpad(CAST(event_id AS STRING), 8, '0')) AS session_id,
       CASE WHEN event_id % 10 = 0 THEN NULL
            ELSE concat('CRM_', lpad(CAST(user_id AS STRING), 6, '0')) END AS customer_id,
       ts AS timestamp, CAST(1 + event_id % 20 AS INT) AS pages_visited,
       CAST(10 + floor(value) AS INT) AS time_on_site,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS referrer,
       concat('home,', event_type) AS pages_path
FROM {events}
"""

SUPPORT_TICKETS_SQL = """
SELECT concat('TKT_', lpad(CAST(event_id AS STRING), 6, '0')) AS ticket_id,
       concat('CRM_', lpad(CAST(user_id AS STRING), 6, '0')) AS customer_id, ts AS created_at,
       CASE WHEN event_id % 3 = 0 THEN 'Billing' WHEN event_id % 3 = 1 THEN 'Technical' ELSE 'Returns' END AS category,
       value AS resolution_time_hours, CAST(1 + event_id % 5 AS INT) AS satisfaction_score,
       CASE WHEN event_id % 5 < 3 THEN 'resolved' WHEN event_id % 5 = 3 THEN 'open' ELSE 'pending' END AS status
FROM {events} WHERE event_type = 'error'
"""

DERIVED = {
    "crm_customers": (CRM_CUSTOMERS_SQL, ("customer", "part", "nation")),
    "transactions": (TRANSACTIONS_SQL, ("orders",)),
    "web_sessions": (WEB_SESSIONS_SQL, ("events",)),
    "support_tickets": (SUPPORT_TICKETS_SQL, ("events",)),
}


def derived_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the four tables over the parquet files in ``sf_dir``."""
    text, sources = DERIVED[table]
    frames = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in sources}
    return conform(spark.sql(text, **frames), table)
