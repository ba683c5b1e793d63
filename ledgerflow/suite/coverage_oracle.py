"""DuckDB oracles for ``coverage_queries`` (same column names; the derivation rules are
restated in SQL)."""

from __future__ import annotations

from ledgerflow.suite.oracle import CLIENTS, EMP, PROJ, with_


def project_dimension_sql() -> str:
    return with_(PROJ, CLIENTS, EMP) + """SELECT p.project_id, p.project_number,
  concat_ws(' ', p.project_number, concat_ws(' : ', c.client_name, p.project_name)) AS project_display_name,
  p.customer_id AS client_id, c.client_name, p.project_status_rank, p.project_status_label,
  coalesce(p.is_complete, false) AS is_complete, p.start_date, m.employee_name AS project_lead
FROM proj p
LEFT JOIN clients c ON p.customer_id = c.client_id
LEFT JOIN emp m ON p.project_manager_id = m.employee_id"""


def client_dimension_sql() -> str:
    return with_(CLIENTS) + "SELECT client_id, client_number, client_name, is_internal FROM clients"


def client_slicer_sql() -> str:
    return "SELECT DISTINCT c_name AS client_name FROM customer WHERE NOT (c_mktsegment = 'MACHINERY')"


def conform_order_lines_sql() -> str:
    return """SELECT 'shopfront' AS source, CAST(o_orderkey AS VARCHAR) AS order_id, CAST(i AS INTEGER) AS line_number,
  'P' || CAST(o_custkey + i AS VARCHAR) AS sku, CAST(i AS BIGINT) AS quantity,
  CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS unit_price
FROM (SELECT o_orderkey, o_custkey, o_totalprice, unnest(generate_series(1, 1 + o_orderkey % 4)) AS i
      FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH'))
UNION ALL
SELECT 'cartwheel', CAST(l_orderkey AS VARCHAR), CAST(NULL AS INTEGER), 'P' || CAST(l_partkey AS VARCHAR),
  CAST(trunc(l_quantity) AS BIGINT), CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS DOUBLE) / 100.0
FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH'))"""


def earthquake_feed_sql() -> str:
    iso = "strftime(epoch_ms({ms}), '%Y-%m-%dT%H:%M:%S.%g') || '+00:00'"
    return f"""WITH f AS (
  SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000 AS ms,
         value / 50 AS mag, CAST(floor(value * 2) AS BIGINT) AS sig
  FROM events),
flat AS (
  SELECT 'ev' || CAST(event_id AS VARCHAR) AS id, mag, sig, 'near user ' || CAST(user_id AS VARCHAR) AS place,
         ms, {iso.format(ms='ms')} AS time, {iso.format(ms='ms + 60000')} AS updated,
         'ev' || CAST(event_id AS VARCHAR) AS first_id, event_type AS first_source, 'phase-data' AS second_type,
         CAST((user_id * 7) % 360 AS DOUBLE) - 180 AS longitude,
         CAST((event_id * 13) % 180 AS DOUBLE) - 90 AS latitude,
         value / 10 AS depth_km
  FROM f)
SELECT 'earthquakes' AS job, id, mag, sig, place, time, updated, first_id, first_source, second_type,
       longitude, latitude, depth_km
FROM flat WHERE mag >= 2.5
UNION ALL
SELECT 'significant_earthquakes', id, mag, sig, place, time, updated, first_id, first_source, second_type,
       longitude, latitude, depth_km
FROM flat WHERE sig >= 600 AND epoch_ms(ms) >= TIMESTAMP '2024-01-10 00:00:00'"""


def saved_watermarks_sql() -> str:
    return """WITH runs AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id, 'events' AS consumer, event_type AS job,
         CASE WHEN value < 5 THEN 'running' WHEN value < 20 THEN 'failed' ELSE 'succeeded' END AS status,
         CASE WHEN value >= 5 THEN ts + INTERVAL 1 MINUTE END AS finished_at,
         CASE WHEN value < 400 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS miv
  FROM events),
ranked AS (
  SELECT consumer, job, miv,
         row_number() OVER (PARTITION BY consumer, job ORDER BY finished_at DESC, run_id DESC) AS rn
  FROM runs WHERE status = 'succeeded' AND miv IS NOT NULL)
SELECT consumer, job, miv AS watermark,
       strftime(greatest(TIMESTAMP '2024-01-05 00:00:00',
                         strptime(miv, '%Y-%m-%dT%H:%M:%S') - INTERVAL 1800 SECOND), '%Y-%m-%dT%H:%M:%S') AS lower_bound
FROM ranked WHERE rn = 1"""


def insert_only_keys_sql() -> str:
    return "SELECT DISTINCT user_id, event_type FROM events WHERE ts IS NOT NULL"


_ACTIVITY = """r AS (
  SELECT user_id, event_type, event_id, value, ts, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS updated_at FROM events),
w1 AS (SELECT max(updated_at) AS wm FROM r WHERE ts < TIMESTAMP '2024-01-15 00:00:00'),
w2 AS (SELECT max(updated_at) AS wm FROM r)"""


def incremental_load_runs_sql() -> str:
    return f"""WITH {_ACTIVITY}
SELECT 1 AS run_seq, 'succeeded' AS status,
       (SELECT count(*) FROM r WHERE ts < TIMESTAMP '2024-01-15 00:00:00' AND updated_at >= '2024-01-01T00:00:00')
         AS records_loaded,
       '2024-01-01T00:00:00' AS lower_bound, (SELECT wm FROM w1) AS max_incremental_value,
       false AS unknown_field_error
UNION ALL
SELECT 2, 'succeeded', (SELECT count(*) FROM r WHERE updated_at >= (SELECT wm FROM w1)),
       (SELECT wm FROM w1), (SELECT wm FROM w2), false
UNION ALL
SELECT 3, 'failed', 0, (SELECT wm FROM w2), NULL, true"""


def incremental_load_table_sql() -> str:
    return f"""WITH {_ACTIVITY},
last AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn,
         max(updated_at) OVER (PARTITION BY user_id, event_type) AS latest
  FROM r)
SELECT user_id, event_type, event_id, value, updated_at,
       CASE WHEN latest >= (SELECT wm FROM w1) THEN 'run-2' ELSE 'run-1' END AS _run_id
FROM last WHERE rn = 1"""


def rendered_orders_sql() -> str:
    return """SELECT o_orderkey AS id, o_custkey AS entity, o_orderstatus AS status,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS trandate
FROM orders"""


def landed_records_sql() -> str:
    return """SELECT event_id // 1000 AS page,
  CAST(row_number() OVER (PARTITION BY event_id // 1000 ORDER BY event_id) - 1 AS BIGINT) AS pos,
  event_id, event_type, value
FROM events"""


def oracle_sql() -> dict[str, str]:
    return {
        "project_dimension": project_dimension_sql(),
        "client_dimension": client_dimension_sql(),
        "client_slicer": client_slicer_sql(),
        "conform_order_lines": conform_order_lines_sql(),
        "earthquake_feed": earthquake_feed_sql(),
        "saved_watermarks": saved_watermarks_sql(),
        "insert_only_keys": insert_only_keys_sql(),
        "incremental_load_runs": incremental_load_runs_sql(),
        "incremental_load_table": incremental_load_table_sql(),
        "rendered_orders": rendered_orders_sql(),
        "landed_records": landed_records_sql(),
    }
