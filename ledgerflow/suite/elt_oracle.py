"""DuckDB oracles for the extract-load queries (independent SQL restatements)."""

from __future__ import annotations

CLS = """CASE t WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'BIGINT' THEN 'integer'
  WHEN 'UBIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'number' WHEN 'VARCHAR' THEN 'string'
  WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' END"""


def _nodes(paths: list[tuple[str, str, str | None]], formats: list[str] = ()) -> str:
    """Node rows per (path, json path, parent json path or None for top level)."""
    dt_extra = "".join(f" OR try_strptime(s, '{f}') IS NOT NULL" for f in formats)
    parts = []
    for name, jp, parent in paths:
        if name.endswith("[]"):
            parts.append(f"""SELECT '{name}' AS path, ordinal, json_type(e) AS t, json_extract_string(e, '$') AS s,
                'array' AS parent_kind, NULL AS parent_objects
              FROM r, unnest(CAST(json_extract(j, '{jp}') AS JSON[])) AS u(e)
              WHERE json_type(j, '{jp}') = 'ARRAY'""")
        elif parent is None:
            parts.append(f"""SELECT '{name}' AS path, ordinal, json_type(j, '{jp}') AS t,
                json_extract_string(j, '{jp}') AS s, 'object' AS parent_kind,
                (SELECT count(*) FROM r) AS parent_objects
              FROM r WHERE json_type(j, '{jp}') IS NOT NULL""")
        else:
            parts.append(f"""SELECT '{name}' AS path, ordinal, json_type(j, '{jp}') AS t,
                json_extract_string(j, '{jp}') AS s, 'object' AS parent_kind,
                (SELECT count(*) FROM r WHERE json_type(j, '{parent}') = 'OBJECT') AS parent_objects
              FROM r WHERE json_type(j, '{parent}') = 'OBJECT' AND json_type(j, '{jp}') IS NOT NULL""")
    union = "\nUNION ALL\n".join(parts)
    return f"""nodes0 AS ({union}),
nodes AS (
  SELECT *, {CLS} AS cls,
    coalesce(regexp_full_match(s, '\\d{{4}}-\\d{{2}}-\\d{{2}}') AND try_cast(s AS DATE) IS NOT NULL, false) AS is_date,
    coalesce((regexp_matches(s, '^\\d{{4}}-\\d{{2}}-\\d{{2}}[T ]\\d{{2}}:\\d{{2}}') AND try_cast(s AS TIMESTAMP) IS NOT NULL){dt_extra}, false) AS is_dt
  FROM nodes0)"""


SCHEMA_TABLE = """SELECT path,
  CASE WHEN count(*) FILTER (WHERE cls <> 'null') = 0 THEN 'null'
       WHEN bool_and(cls = 'integer') FILTER (WHERE cls <> 'null') THEN 'integer'
       WHEN bool_and(cls IN ('integer', 'number')) FILTER (WHERE cls <> 'null') THEN 'number'
       WHEN count(DISTINCT cls) FILTER (WHERE cls <> 'null') = 1 THEN any_value(cls) FILTER (WHERE cls <> 'null')
       ELSE 'conflict' END AS type,
  CASE WHEN count(*) FILTER (WHERE cls NOT IN ('null', 'string')) = 0 AND count(*) FILTER (WHERE cls = 'string') > 0
       THEN CASE WHEN bool_and(is_date) FILTER (WHERE cls = 'string') THEN 'date'
                 WHEN bool_and(is_date OR is_dt) FILTER (WHERE cls = 'string') THEN 'date-time' END END AS format,
  (bool_or(cls = 'null') OR count(*) FILTER (WHERE cls <> 'null') = 0
     OR (any_value(parent_kind) = 'object' AND count(*) < max(parent_objects))) AS nullable,
  CAST(count(*) AS BIGINT) AS present
FROM nodes GROUP BY path"""


def infer_events_props_sql() -> str:
    rec = """r AS (SELECT event_id AS ordinal, json_object('id', event_id, 'at', strftime(ts, '%Y-%m-%dT%H:%M:%S'),
    'user_id', user_id, 'event_type', event_type, 'value', value, 'props', json(props)) AS j FROM events)"""
    nodes = _nodes([("id", "$.id", None), ("at", "$.at", None), ("user_id", "$.user_id", None),
                    ("event_type", "$.event_type", None), ("value", "$.value", None), ("props", "$.props", None),
                    ("props.k", "$.props.k", "$.props")], ["%Y-%m-%dT%H:%M:%S"])
    return f"WITH {rec},\n{nodes}\n{SCHEMA_TABLE}"


def infer_mixed_sql() -> str:
    base = """'id', event_id,
      'amount', CASE event_type WHEN 'purchase' THEN value WHEN 'view' THEN CAST(round(value) AS BIGINT) END,
      'when', CASE WHEN event_type = 'signup' THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END,
      'tags', CASE WHEN event_type = 'error' THEN CAST('[]' AS JSON) ELSE json_array(event_type) END,
      'meta', CASE WHEN event_type <> 'error' THEN json(props) END"""
    rec = f"""r AS (SELECT event_id AS ordinal,
    CASE WHEN event_type = 'click' THEN json_object({base}, 'label', 'user ' || CAST(user_id AS VARCHAR))
         ELSE json_object({base}) END AS j FROM events)"""
    nodes = _nodes([("id", "$.id", None), ("amount", "$.amount", None), ("when", "$.when", None),
                    ("tags", "$.tags", None), ("tags[]", "$.tags", None), ("meta", "$.meta", None),
                    ("meta.k", "$.meta.k", "$.meta"), ("label", "$.label", None)])
    return f"WITH {rec},\n{nodes}\n{SCHEMA_TABLE}"


def schema_document_sql() -> str:
    return f"""SELECT path, type, format, nullable, (SELECT count(*) FROM events) AS records
FROM ({infer_mixed_sql()})"""


def infer_conflicts_sql() -> str:
    rec = """r AS (SELECT event_id AS ordinal,
    CASE WHEN event_type = 'error' THEN json_object('id', event_id, 'x', event_type, 'y', value)
         WHEN event_type = 'signup' THEN json_object('id', event_id, 'x', user_id, 'y', value > 10)
         ELSE json_object('id', event_id, 'x', user_id, 'y', value) END AS j FROM events)"""
    nodes = _nodes([("id", "$.id", None), ("x", "$.x", None), ("y", "$.y", None)])
    return f"""WITH {rec},
{nodes},
s AS (SELECT path, cls, CAST(count(*) AS BIGINT) AS n, min(ordinal) AS first_ordinal FROM nodes GROUP BY 1, 2),
w AS (SELECT *, list_distinct(list(CASE WHEN cls <> 'null' THEN cls END) OVER (
        PARTITION BY path ORDER BY first_ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS seen FROM s),
f AS (SELECT *, NOT (len(seen) <= 1 OR list_bool_and(list_transform(seen, lambda c: c IN ('integer', 'number')))) AS bad FROM w)
SELECT path, cls, n, first_ordinal, min(first_ordinal) FILTER (WHERE bad) OVER (PARTITION BY path) AS conflict_at FROM f"""


def _last(where: str, keys: str) -> str:
    return f"""SELECT user_id, event_type, event_id, value FROM events WHERE {where}
    QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY event_id DESC) = 1"""


def upsert_last_write_sql() -> str:
    return f"""WITH a AS ({_last("ts < TIMESTAMP '2024-01-15 00:00:00'", "user_id, event_type")}),
b AS ({_last("ts >= TIMESTAMP '2024-01-15 00:00:00'", "user_id, event_type")})
SELECT * FROM b
UNION ALL
SELECT a.* FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.user_id = a.user_id AND b.event_type = a.event_type)"""


def tombstone_upsert_sql() -> str:
    return f"""WITH a AS ({_last("ts < TIMESTAMP '2024-01-15 00:00:00'", "user_id")}),
b AS ({_last("ts >= TIMESTAMP '2024-01-15 00:00:00'", "user_id")})
SELECT user_id, CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
       CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
       CASE WHEN event_type <> 'error' THEN value END AS value, event_type = 'error' AS deleted
FROM b
UNION ALL
SELECT a.*, false AS deleted FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.user_id = a.user_id)"""


def stream_upsert_sql() -> str:
    return _last("true", "user_id, event_type")


def snapshot_latest_run_sql() -> str:
    return "SELECT o_orderkey, o_orderstatus, 'run-2' AS _run_id FROM orders WHERE o_orderstatus <> 'P'"


def incremental_bound_sql() -> str:
    return """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-06-30 00:00:00'"""


def lookback_reload_sql() -> str:
    return """SELECT event_id, strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') || '+02:00' AS updated_at FROM events
WHERE date_trunc('second', ts) >= TIMESTAMP '2024-01-20 11:30:00'"""


def exclusive_to_inclusive_sql() -> str:
    return """SELECT event_id FROM events
WHERE date_trunc('second', ts) > TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 1 SECOND"""


def epoch_roundtrip_sql() -> str:
    return """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_seconds,
  strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS roundtrip,
  strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S.%g') AS iso_millis,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS watermark,
  CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) AS epoch_text
FROM events"""


def unknown_fields_sql() -> str:
    return """SELECT event_id, CASE event_type WHEN 'click' THEN 'note' ELSE 'debug,extra' END AS unknown
FROM events WHERE event_type IN ('click', 'error')"""


def envelope_unnest_sql() -> str:
    return """SELECT event_id // 100 AS page,
  CAST(row_number() OVER (PARTITION BY event_id // 100 ORDER BY event_id) - 1 AS BIGINT) AS pos,
  event_id, event_type AS first_label, CAST(2 AS INTEGER) AS n_labels, true AS links_dropped
FROM events"""


def conform_orders_sql() -> str:
    status = "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'pending' END"
    return f"""SELECT 'shopfront' AS source, CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
  {status} AS status, 'USD' AS currency, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS total,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS placed_at, false AS is_deleted
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
UNION ALL
SELECT 'cartwheel', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), {status}, 'EUR',
  CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DOUBLE) / 100.0,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), o_orderstatus = 'P'
FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')"""


def conform_tickets_sql() -> str:
    return """SELECT 'ticketdesk' AS source, CAST(event_id AS VARCHAR) AS ticket_id,
  CASE WHEN event_type = 'view' THEN 'open' ELSE 'solved' END AS status,
  CASE WHEN value > 100 THEN 'urgent' ELSE 'normal' END AS priority,
  'u' || CAST(user_id AS VARCHAR) || '@x.io' AS requester_email, CAST(user_id AS VARCHAR) AS assignee_id,
  event_type AS tags, value AS hours
FROM events WHERE event_type IN ('view', 'click')
UNION ALL
SELECT 'helpline', CAST(event_id AS VARCHAR),
  CASE WHEN event_type = 'signup' THEN 'pending' ELSE 'open' END,
  CASE WHEN value > 100 THEN 'urgent' ELSE 'normal' END,
  'u' || CAST(user_id AS VARCHAR) || '@x.io', CAST(user_id AS VARCHAR),
  event_type || '|vip', CAST(CAST(round(value * 60) AS BIGINT) AS DOUBLE) / CAST(60 AS DOUBLE)
FROM events WHERE event_type IN ('signup', 'purchase')"""


def _status(sev: str) -> str:
    return f"CASE WHEN failures = 0 THEN 'pass' WHEN '{sev}' = 'error' THEN 'fail' ELSE 'warn' END"


def _check(name: str, sev: str, count_sql: str) -> str:
    return f"""SELECT '{name}' AS "check", '{sev}' AS severity, failures, {_status(sev)} AS status
FROM (SELECT CAST(({count_sql}) AS BIGINT) AS failures)"""


def dq_not_null_sql() -> str:
    parts = [_check(f"not_null_{t}_{c}", "error", f"SELECT count(*) FROM {t} WHERE {c} IS NULL")
             for t, c in (("orders", "o_orderkey"), ("orders", "o_custkey"), ("lineitem", "l_orderkey"), ("customer", "c_name"))]
    return "\nUNION ALL\n".join(parts)


def dq_accepted_sql() -> str:
    return "\nUNION ALL\n".join([
        _check("accepted_orderstatus", "error",
               "SELECT count(*) FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')"),
        _check("accepted_segment", "warn",
               "SELECT count(*) FROM customer WHERE c_mktsegment IS NOT NULL AND c_mktsegment NOT IN "
               "('BUILDING', 'AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD', 'FURNITURE')"),
    ])


def dq_relationships_sql() -> str:
    return "\nUNION ALL\n".join([
        _check("customer_has_orders", "warn",
               "SELECT count(*) FROM customer c WHERE c.c_custkey IS NOT NULL AND NOT EXISTS "
               "(SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)"),
        _check("orders_to_customer", "error",
               "SELECT count(*) FROM orders o WHERE o.o_custkey IS NOT NULL AND NOT EXISTS "
               "(SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)"),
    ])


def dq_unique_sql() -> str:
    return """SELECT l_orderkey, CAST(count(*) AS BIGINT) AS occurrences FROM lineitem
WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1"""


def dq_unique_combo_sql() -> str:
    return """SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS occurrences FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1"""


def dq_freshness_sql() -> str:
    return """SELECT strftime(m, '%Y-%m-%d %H:%M:%S.%f') AS latest_loaded_at,
  CAST(epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(m) AS DOUBLE) / CAST(3600000000 AS DOUBLE) AS age_hours,
  coalesce(CAST(epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(m) AS DOUBLE) / CAST(3600000000 AS DOUBLE) > 36, true) AS is_stale
FROM (SELECT max(ts) AS m FROM events)"""


def conform_customers_sql() -> str:
    return """SELECT 'shopfront' AS source, 's' || CAST(c_custkey AS VARCHAR) AS customer_id,
  lower(c_name) || '@x.io' AS email, c_name AS full_name,
  CASE WHEN c_acctbal > 5000 THEN 'pro' END AS tier, c_acctbal > 0 AS marketing_opt_in,
  'City ' || CAST(c_nationkey AS VARCHAR) AS city, 'NO' AS country,
  '2024-01-01 00:00:00' AS created_at, false AS is_deleted
FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE')
UNION ALL
SELECT 'cartwheel', CAST(c_custkey AS VARCHAR), lower(c_name) || '@x.io',
  concat_ws(' ', nullif(split_part(c_name, '#', 1), ''), nullif(split_part(c_name, '#', 2), '')),
  CASE WHEN c_acctbal > 5000 THEN 'gold' END, c_acctbal > 0,
  CASE WHEN c_nationkey < 12 THEN 'City ' || CAST(c_nationkey AS VARCHAR) END, 'DE',
  '2024-01-01 00:00:00', c_acctbal < 0
FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'FURNITURE')"""


def conform_agents_sql() -> str:
    return """SELECT 'ticketdesk' AS source, CAST(s_suppkey AS VARCHAR) AS agent_id, s_name AS name,
  lower(s_name) || '@desk.io' AS email, 'team ' || CAST(s_nationkey AS VARCHAR) AS team, s_acctbal >= 0 AS is_active
FROM supplier WHERE s_nationkey < 12
UNION ALL
SELECT 'helpline', 'S' || CAST(s_suppkey AS VARCHAR), s_name, lower(s_name) || '@help.io',
  'Tier ' || CAST(s_nationkey AS VARCHAR), s_acctbal >= 0
FROM supplier WHERE s_nationkey >= 12"""


def uncategorized_items_sql() -> str:
    from ledgerflow.suite.oracle import BASE, with_

    return with_(*BASE) + """SELECT item_name, CAST(count(*) AS BIGINT) AS entries,
  CAST(CAST(sum(hours) AS DECIMAL(18,2)) AS DOUBLE) AS hours
FROM cte WHERE category_code = 'unmapped' GROUP BY item_name"""


def top_client_hours_chart_sql() -> str:
    from ledgerflow.suite.oracle import BASE, CLIENTS, with_

    return with_(*BASE, CLIENTS) + """SELECT c.client_name, CAST(sum(e.client_facing_hours) AS DOUBLE) AS client_hours
FROM cte e JOIN clients c ON e.client_id = c.client_id AND NOT c.is_internal
GROUP BY e.client_id, c.client_name
ORDER BY client_hours DESC NULLS LAST, client_name LIMIT 10"""


def employee_dimension_sql() -> str:
    from ledgerflow.suite.oracle import BASE, CAL, DEPTS, DIM_EMP, with_

    return with_(*BASE, CAL, DEPTS, DIM_EMP) + """SELECT employee_id, employee_name, department_name, group_name,
  hire_date, release_date, employment_status, CAST(standard_hours_per_day AS DOUBLE) AS standard_hours_per_day
FROM dim_emp"""


def schema_drift_sql() -> str:
    return f"""WITH fresh AS ({infer_mixed_sql()}),
committed AS ({infer_events_props_sql()})
SELECT coalesce(f.path, c.path) AS path, f.type AS fresh_type, f.format AS fresh_format,
  f.nullable AS fresh_nullable, c.type AS committed_type, c.format AS committed_format,
  c.nullable AS committed_nullable
FROM fresh f FULL JOIN committed c ON f.path = c.path
WHERE f.type IS DISTINCT FROM c.type OR f.format IS DISTINCT FROM c.format OR f.nullable IS DISTINCT FROM c.nullable"""


def contract_report_sql() -> str:
    from ledgerflow.plans.contracts import CONTRACTS

    values = ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(CONTRACTS["fct_time_entries"]))
    return f"""SELECT c.name AS "column", c.expected_type, c.expected_type AS actual_type,
  CAST(NULL AS VARCHAR) AS problem, CAST(0 AS BIGINT) AS uncastable,
  (SELECT count(*) FROM events) AS rows_checked
FROM (VALUES {values}) AS c(pos, name, expected_type)"""


def oracle_sql() -> dict[str, str]:
    return {
        "conform_customers": conform_customers_sql(),
        "conform_agents": conform_agents_sql(),
        "uncategorized_items": uncategorized_items_sql(),
        "top_client_hours_chart": top_client_hours_chart_sql(),
        "employee_dimension": employee_dimension_sql(),
        "schema_drift": schema_drift_sql(),
        "contract_report": contract_report_sql(),
        "infer_events_props": infer_events_props_sql(),
        "infer_mixed": infer_mixed_sql(),
        "infer_conflicts": infer_conflicts_sql(),
        "merged_schema": infer_mixed_sql(),
        "merged_conflicts": infer_conflicts_sql(),
        "schema_by_landing": schema_document_sql(),
        "merged_schema_documents": schema_document_sql(),
        "upsert_last_write": upsert_last_write_sql(),
        "tombstone_upsert": tombstone_upsert_sql(),
        "snapshot_latest_run": snapshot_latest_run_sql(),
        "incremental_bound": incremental_bound_sql(),
        "landed_bound": incremental_bound_sql(),
        "snapshot_partitioned": snapshot_latest_run_sql(),
        "lookback_reload": lookback_reload_sql(),
        "exclusive_to_inclusive": exclusive_to_inclusive_sql(),
        "epoch_roundtrip": epoch_roundtrip_sql(),
        "unknown_fields": unknown_fields_sql(),
        "envelope_unnest": envelope_unnest_sql(),
        "conform_orders": conform_orders_sql(),
        "conform_tickets": conform_tickets_sql(),
        "dq_unique": dq_unique_sql(),
        "dq_not_null": dq_not_null_sql(),
        "dq_accepted": dq_accepted_sql(),
        "dq_relationships": dq_relationships_sql(),
        "dq_unique_combo": dq_unique_combo_sql(),
        "dq_freshness": dq_freshness_sql(),
        "stream_upsert": stream_upsert_sql(),
    }
