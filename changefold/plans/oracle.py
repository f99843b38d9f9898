"""DuckDB SQL oracles, one per registered query.

Each oracle restates the fixture adapter rules of ``sources.fixtures`` and
the operator semantics in plain SQL over the driver's tables, without any
of the Spark code paths (no JSON round trip, no fold by struct ordering).
"""

from __future__ import annotations

# --- adapter CTEs ----------------------------------------------------------

S_ORDERS = """
s_orders AS (
  SELECT o_orderkey AS order_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CAST(o_orderdate AS DATE) + 10 AS delivery_date,
         o_custkey AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'P' THEN 'PENDING'
              WHEN 'O' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'PROCESSING' ELSE 'REPROCESSING' END
         END AS status,
         false AS _deleted
  FROM orders)"""

S_ITEMS = """
s_items AS (
  SELECT l_orderkey * 1000 + row_number() OVER (
           PARTITION BY l_orderkey
           ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
                    l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS order_item_id,
         l_orderkey AS order_id,
         l_partkey AS product_id,
         CAST(trunc(l_quantity) AS INTEGER) AS quantity,
         CAST(l_shipdate AS DATE) AS ship_date,
         false AS _deleted
  FROM lineitem)"""

OPEN_ORDERS = """
open_orders AS (
  SELECT i.order_id, o.delivery_date, o.status, o.customer_id, o.order_date,
         i.order_item_id, i.product_id, i.quantity
  FROM s_items i JOIN s_orders o ON i.order_id = o.order_id
  WHERE NOT i._deleted AND NOT o._deleted AND o.status <> 'COMPLETED')"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


GOLD = with_ctes(S_ORDERS, S_ITEMS, OPEN_ORDERS)

SQL: dict[str, str] = {
    "open_orders": GOLD + "SELECT * FROM open_orders",
    "open_orders_stream": GOLD + "SELECT * FROM open_orders",
    "kpi_open_orders_by_date_status": GOLD + """
SELECT delivery_date, status, COUNT(DISTINCT order_id) AS order_count
FROM open_orders GROUP BY delivery_date, status ORDER BY delivery_date, status""",
    "kpi_top_delivery_dates": GOLD + """
SELECT delivery_date, COUNT(DISTINCT order_id) AS open_order_count
FROM open_orders GROUP BY delivery_date
ORDER BY open_order_count DESC, delivery_date ASC LIMIT 3""",
    "kpi_pending_items_by_product": GOLD + """
SELECT product_id, COUNT(*) AS pending_item_count
FROM open_orders WHERE status = 'PENDING' GROUP BY product_id
ORDER BY pending_item_count DESC, product_id ASC""",
    "kpi_top_customers_pending": GOLD + """
SELECT customer_id, COUNT(DISTINCT order_id) AS pending_order_count
FROM open_orders WHERE status = 'PENDING' GROUP BY customer_id
ORDER BY pending_order_count DESC, customer_id ASC LIMIT 3""",
}

# --- change log from events ------------------------------------------------

TOPIC_EVENTS = "finance_db.operations.user_events"

CH = f"""
ch AS (
  SELECT event_id, user_id, value, props,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'purchase' THEN 'r' WHEN 'error' THEN 'd'
              ELSE 'u' END AS op,
         CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS ts_ms,
         event_id // 1000 AS batch_id,
         CAST(user_id % 8 AS INTEGER) AS part,
         CASE WHEN event_id % 97 = 0 THEN 'json_parse_failure'
              WHEN event_id % 101 = 0 THEN 'missing_op'
              WHEN event_id % 103 = 0 THEN 'schema_mismatch'
              WHEN event_id % 89 = 0 THEN 'null_value' END AS damage
  FROM events)"""


def state_sql(where: str = "TRUE") -> str:
    return with_ctes(CH) + f"""
SELECT user_id,
       arg_max(value, (ts_ms, event_id)) FILTER (WHERE op <> 'd') AS value,
       arg_max(props, (ts_ms, event_id)) FILTER (WHERE op <> 'd') AS props,
       max(ts_ms) AS updated_at_ms,
       min(ts_ms) FILTER (WHERE op <> 'd') AS created_at_ms,
       arg_max(op, (ts_ms, event_id)) = 'd' AS _deleted
FROM ch WHERE {where}
GROUP BY user_id
HAVING count(*) FILTER (WHERE op <> 'd') > 0"""


AS_OF_MS = 1705276800000  # 2024-01-15 00:00:00 UTC
PURGE_CUTOFF_MS = 1706616000000  # 2024-01-30 12:00:00 UTC = purge clock 2024-07-30 12:00 - 6 months

SQL.update({
    "cdc_parse": with_ctes(CH) + f"""
SELECT '{TOPIC_EVENTS}' AS topic, part AS "partition", event_id AS "offset", op, ts_ms,
       user_id, value, props, event_id AS lsn
FROM ch""",
    "cdc_dead_letter": with_ctes(CH) + f"""
SELECT '{TOPIC_EVENTS}' AS topic, part AS "partition", event_id AS "offset",
       damage AS dead_letter_reason, batch_id AS dead_letter_batch_id
FROM ch WHERE damage IS NOT NULL AND damage <> 'null_value'""",
    "cdc_null_messages": with_ctes(CH) + f"""
SELECT '{TOPIC_EVENTS}' AS topic, batch_id AS _batch_id, count(*) AS messages,
       count(*) FILTER (WHERE damage = 'null_value') AS null_messages
FROM ch GROUP BY batch_id""",
    "cdc_batch_metrics": with_ctes(CH) + """
SELECT batch_id AS _batch_id,
       count(*) AS messages,
       count(*) FILTER (WHERE damage IS NULL) AS valid,
       count(*) FILTER (WHERE damage IS NOT NULL) AS dead_letter,
       count(*) FILTER (WHERE damage IS NULL AND op <> 'd') AS upserts,
       count(*) FILTER (WHERE damage IS NULL AND op = 'd') AS deletes
FROM ch WHERE damage IS DISTINCT FROM 'null_value' GROUP BY batch_id""",
    "cdc_latest_per_batch": with_ctes(CH) + """
SELECT batch_id AS _batch_id, user_id, op, ts_ms, event_id AS "offset", value, props
FROM ch
QUALIFY row_number() OVER (PARTITION BY batch_id, user_id ORDER BY ts_ms DESC, event_id DESC) = 1""",
    "cdc_upserts": with_ctes(CH) + """
SELECT user_id, value, props, ts_ms, event_id AS "offset", false AS _deleted FROM ch WHERE op <> 'd'""",
    "cdc_deletes": with_ctes(CH) + """
SELECT user_id, ts_ms, event_id AS "offset" FROM ch WHERE op = 'd'""",
    "cdc_state": state_sql(),
    "cdc_state_incremental": state_sql(),
    "cdc_state_stream": state_sql(),
    "cdc_state_as_of": state_sql(f"ts_ms <= {AS_OF_MS}"),
    "cdc_history": with_ctes(CH) + """
SELECT user_id, op, ts_ms AS valid_from_ms,
       lead(ts_ms) OVER (PARTITION BY user_id ORDER BY ts_ms, event_id) AS valid_to_ms,
       value, props, op = 'd' AS _deleted
FROM ch""",
    "purge_deleted": f"""
SELECT * FROM ({state_sql()}) s
WHERE NOT (_deleted AND updated_at_ms < {PURGE_CUTOFF_MS})""",
    "convert_dates": """
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
       CAST(o_orderdate AS DATE) + 10 AS delivery_date FROM orders""",
    "convert_timestamps": """
SELECT event_id, CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS ts_ms,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts_text FROM events""",
    "convert_decimals": """
SELECT p_partkey AS product_id, CASE WHEN p_partkey % 2 = 0 THEN 'text' ELSE 'object' END AS wire_form,
       CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS unity_price FROM part""",
    "item_rename": with_ctes(S_ITEMS) + """
SELECT order_item_id, order_id, product_id, quantity, _deleted FROM s_items""",
    "orders_snapshot_state": with_ctes(S_ORDERS) + """
SELECT order_id, order_date, delivery_date, customer_id, status, _deleted FROM s_orders""",
    "products_snapshot_state": """
SELECT p_partkey AS product_id, p_name AS product_name, lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS barcode,
       CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS unity_price, true AS is_active,
       false AS _deleted FROM part""",
    "compact_clustered": with_ctes(S_ORDERS) + """
SELECT order_id, order_date, delivery_date, customer_id, status, _deleted FROM s_orders""",
})

SQL.update({
    "customers_snapshot_state": """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_acctbal >= 0 AS is_active,
       'NATION ' || CAST(c_nationkey AS VARCHAR) AS customer_address,
       CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS BIGINT) AS updated_at_ms,
       c_acctbal < 0 AS _deleted
FROM customer""",
    "cdc_route_topics": with_ctes(CH, S_ITEMS) + """
SELECT table_name, "partition", count(*) AS messages,
       count(*) FILTER (WHERE is_null) AS null_messages
FROM (
  SELECT 'user_events' AS table_name, part AS "partition", damage = 'null_value' AS is_null FROM ch
  UNION ALL SELECT 'orders', CAST(o_orderkey % 8 AS INTEGER), false FROM orders
  UNION ALL SELECT 'order_items', CAST(order_item_id % 8 AS INTEGER), false FROM s_items
  UNION ALL SELECT 'products', CAST(p_partkey % 8 AS INTEGER), false FROM part
  UNION ALL SELECT 'customers', CAST(c_custkey % 8 AS INTEGER), false FROM customer
  UNION ALL SELECT 'customers', CAST(c_custkey % 8 AS INTEGER), false FROM customer WHERE c_acctbal < 0
) m
GROUP BY table_name, "partition"
""",
})

SQL.update({
    "orders_lifecycle_state": with_ctes(S_ORDERS) + """
SELECT order_id, order_date, delivery_date, customer_id, status,
       CAST(epoch_ms(CAST(order_date AS TIMESTAMP)) AS BIGINT)
         + CASE status WHEN 'COMPLETED' THEN 2 WHEN 'PENDING' THEN 0 ELSE 1 END * 3600000 AS updated_at_ms,
       CAST(epoch_ms(CAST(order_date AS TIMESTAMP)) AS BIGINT) AS created_at_ms,
       _deleted
FROM s_orders""",
})

STAGES = """
stages AS (
  SELECT order_id, s.stage, s.status,
         CAST(epoch_ms(CAST(order_date AS TIMESTAMP)) AS BIGINT) + s.stage * 3600000 AS ts_ms
  FROM s_orders,
       UNNEST(CASE status WHEN 'COMPLETED' THEN [{'stage': 0, 'status': 'PENDING'},
                                                 {'stage': 1, 'status': 'PROCESSING'},
                                                 {'stage': 2, 'status': 'COMPLETED'}]
                          WHEN 'PENDING' THEN [{'stage': 0, 'status': 'PENDING'}]
                          ELSE [{'stage': 0, 'status': 'PENDING'}, {'stage': 1, 'status': status}] END) AS t(s))"""

SQL.update({
    "orders_history": with_ctes(S_ORDERS, STAGES) + """
SELECT order_id, CASE WHEN stage = 0 THEN 'c' ELSE 'u' END AS op, status,
       ts_ms AS valid_from_ms,
       lead(ts_ms) OVER (PARTITION BY order_id ORDER BY ts_ms) AS valid_to_ms,
       false AS _deleted
FROM stages""",
    "kpi_by_date_status_end_to_end": SQL["kpi_open_orders_by_date_status"],
})

SQL["orders_state_stateful_stream"] = SQL["orders_lifecycle_state"]

# --- updates and soft deletes on all four tables -----------------------------

STEP_1, STEP_2 = 1_001_000, 1_002_000

C_ORDERS = f"""
c_orders AS (
  SELECT order_id, order_date,
         CASE WHEN order_id % 10 = 5 THEN delivery_date + 5 ELSE delivery_date END AS delivery_date,
         customer_id,
         CASE order_id % 10 WHEN 1 THEN 'COMPLETED' WHEN 2 THEN 'PENDING' WHEN 4 THEN NULL WHEN 6 THEN 'PENDING'
              ELSE status END AS status,
         CASE WHEN order_id % 10 BETWEEN 1 AND 5 THEN {STEP_1} WHEN order_id % 10 = 6 THEN {STEP_2}
              ELSE CAST(epoch_ms(CAST(order_date AS TIMESTAMP)) AS BIGINT) END AS updated_at_ms,
         CAST(epoch_ms(CAST(order_date AS TIMESTAMP)) AS BIGINT) AS created_at_ms,
         order_id % 10 = 3 AS _deleted
  FROM s_orders)"""

C_ITEMS = f"""
c_items AS (
  SELECT order_item_id, order_id,
         CASE WHEN order_item_id % 7 = 3 THEN product_id + 1 ELSE product_id END AS product_id,
         CAST(CASE order_item_id % 7 WHEN 1 THEN quantity + 1 WHEN 5 THEN 1 ELSE quantity END AS INTEGER) AS quantity,
         CASE WHEN order_item_id % 7 BETWEEN 1 AND 3 THEN {STEP_1} WHEN order_item_id % 7 = 5 THEN {STEP_2}
              ELSE CAST(epoch_ms(CAST(ship_date AS TIMESTAMP)) AS BIGINT) END AS updated_at_ms,
         CAST(epoch_ms(CAST(ship_date AS TIMESTAMP)) AS BIGINT) AS created_at_ms,
         order_item_id % 7 = 2 AS _deleted
  FROM s_items)"""

C_OPEN = """
open_orders AS (
  SELECT i.order_id, o.delivery_date, o.status, o.customer_id, o.order_date,
         i.order_item_id, i.product_id, i.quantity
  FROM c_items i JOIN c_orders o ON i.order_id = o.order_id
  WHERE NOT i._deleted AND NOT o._deleted AND o.status <> 'COMPLETED')"""

CHANGED_GOLD = with_ctes(S_ORDERS, S_ITEMS, C_ORDERS, C_ITEMS, C_OPEN)

SQL.update({
    "orders_changed_state": with_ctes(S_ORDERS, C_ORDERS) + "SELECT * FROM c_orders",
    "order_items_changed_state": with_ctes(S_ITEMS, C_ITEMS) + "SELECT * FROM c_items",
    "customers_changed_state": f"""
SELECT c_custkey AS customer_id,
       c_name || CASE WHEN c_custkey % 10 = 1 THEN ' RENAMED' ELSE '' END AS customer_name,
       c_acctbal >= 0 AND c_custkey % 10 NOT IN (2, 3) AS is_active,
       'NATION ' || CAST(c_nationkey AS VARCHAR) AS customer_address,
       CAST(CASE WHEN c_custkey % 10 BETWEEN 1 AND 3 THEN {STEP_1} ELSE 0 END AS BIGINT) AS updated_at_ms,
       CAST(0 AS BIGINT) AS created_at_ms,
       c_custkey % 10 = 2 AS _deleted
FROM customer""",
    "products_changed_state": f"""
SELECT p_partkey AS product_id, p_name || CASE WHEN p_partkey % 10 = 4 THEN ' NEW' ELSE '' END AS product_name,
       lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS barcode,
       CAST(CAST(p_retailprice AS DECIMAL(10,2)) + CASE WHEN p_partkey % 10 = 1 THEN 1 ELSE 0 END AS DOUBLE) AS unity_price,
       p_partkey % 10 NOT IN (2, 3) AS is_active,
       CAST(CASE WHEN p_partkey % 10 BETWEEN 1 AND 3 THEN {STEP_1} WHEN p_partkey % 10 = 4 THEN {STEP_2} ELSE 0 END
            AS BIGINT) AS updated_at_ms,
       CAST(0 AS BIGINT) AS created_at_ms,
       p_partkey % 10 = 2 AS _deleted
FROM part""",
    "orders_delete_keys": f"""
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, CAST({STEP_1} AS BIGINT) AS ts_ms,
       CAST(1000000000000 + o_orderkey AS BIGINT) AS "offset"
FROM orders WHERE o_orderkey % 10 IN (3, 6)""",
    "open_orders_changed": CHANGED_GOLD + "SELECT * FROM open_orders",
    "kpi_maintained": CHANGED_GOLD + """
SELECT 'kpi_open_orders_by_date_status' AS kpi, delivery_date, status, CAST(NULL AS BIGINT) AS product_id,
       CAST(NULL AS BIGINT) AS customer_id, COUNT(DISTINCT order_id) AS value
FROM open_orders GROUP BY delivery_date, status
UNION ALL
SELECT 'kpi_top_delivery_dates', delivery_date, NULL, NULL, NULL, n FROM (
  SELECT delivery_date, COUNT(DISTINCT order_id) AS n FROM open_orders GROUP BY delivery_date
  ORDER BY n DESC, delivery_date LIMIT 3)
UNION ALL
SELECT 'kpi_pending_items_by_product', NULL, NULL, product_id, NULL, COUNT(*)
FROM open_orders WHERE status = 'PENDING' GROUP BY product_id
UNION ALL
SELECT 'kpi_top_customers_pending', NULL, NULL, NULL, customer_id, n FROM (
  SELECT customer_id, COUNT(DISTINCT order_id) AS n FROM open_orders WHERE status = 'PENDING' GROUP BY customer_id
  ORDER BY n DESC, customer_id LIMIT 3)""",
})

SQL["compact_zordered"] = SQL["compact_clustered"]
SQL["state_as_of_from_base"] = SQL["cdc_state_as_of"]
SQL["open_orders_bucketed"] = SQL["open_orders"]

# --- one raw stream, redelivered messages, expiring state ---------------------

SQL.update({
    "raw_fanout_stream": with_ctes(CH, S_ITEMS) + """
SELECT 'user_events' AS table_name, 'bronze' AS sink, op AS kind, count(*) AS messages FROM ch
WHERE damage IS NULL GROUP BY op
UNION ALL SELECT 'user_events', 'dead_letter', damage, count(*) FROM ch
WHERE damage IS NOT NULL AND damage <> 'null_value' GROUP BY damage
UNION ALL SELECT 'orders', 'bronze', 'r', count(*) FROM orders HAVING count(*) > 0
UNION ALL SELECT 'order_items', 'bronze', 'r', count(*) FROM s_items HAVING count(*) > 0
UNION ALL SELECT 'products', 'bronze', 'r', count(*) FROM part HAVING count(*) > 0
UNION ALL SELECT 'customers', 'bronze', 'r', count(*) FROM customer HAVING count(*) > 0
UNION ALL SELECT 'customers', 'bronze', 'd', count(*) FROM customer WHERE c_acctbal < 0 HAVING count(*) > 0
UNION ALL SELECT '_unknown', 'dead_letter', 'unknown_topic', count(*) FROM supplier HAVING count(*) > 0""",
    "raw_dedup_stream": with_ctes(CH) + """
SELECT part AS "partition", event_id AS "offset", op, ts_ms, user_id FROM ch""",
    "orders_state_expiring_stream": SQL["orders_lifecycle_state"],
    "orders_touched_by_date": with_ctes(S_ORDERS) + """
SELECT order_id, order_date, delivery_date, customer_id, status FROM s_orders WHERE order_id % 10 IN (3, 6)""",
    "serving_kpis": SQL["kpi_pending_items_by_product"],
    "metric_alerts": """
WITH m AS (
  SELECT event_type AS query, event_id // 100 AS batch_id, CAST(floor(epoch_us(max(ts)) / 1000) AS BIGINT) AS at_ms,
         1000 * count(*) AS duration, max(event_id) % 997 AS behind, count(*) FILTER (WHERE event_id % 501 = 0) AS late
  FROM events GROUP BY ALL),
p AS (SELECT m.*, at_ms // 21600000 * 21600000 - k * 21600000 AS w FROM m, range(4) AS t(k)),
g AS (SELECT *, behind - lag(behind) OVER (PARTITION BY query, w ORDER BY at_ms, batch_id) AS growth FROM p),
s AS (
  SELECT query, w AS window_start_ms, w + 86400000 AS window_end_ms, count(*) AS batches, min(duration) AS shortest,
         min(growth) AS least_growth, sum(growth) AS growth, sum(late) AS late
  FROM g GROUP BY query, w)
SELECT query, window_start_ms, window_end_ms, 'slow_batches' AS alert, batches, CAST(shortest AS DOUBLE) AS value
FROM s WHERE batches >= 2 AND shortest > 17000
UNION ALL SELECT query, window_start_ms, window_end_ms, 'growing_lag', batches, CAST(growth AS DOUBLE)
FROM s WHERE batches >= 2 AND least_growth > 0
UNION ALL SELECT query, window_start_ms, window_end_ms, 'late_rows_dropped', batches, CAST(late AS DOUBLE)
FROM s WHERE late > 0""",
})
