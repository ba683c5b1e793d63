"""DuckDB SQL oracles for the registered queries.

Each oracle restates the stand-in derivation (see ``ledgerflow.plans.standins``) and
the model semantics in plain SQL, independently of the Spark code. Percentages are
rounded HALF_UP on exact integer cents, as NUMERIC rounding does.
"""

from __future__ import annotations


def pct(num: str, den: str, num_scale: int = 2, den_scale: int = 2) -> str:
    """round(num / nullif(den, 0), 4) with HALF_UP on the exact scaled integers, as a
    DOUBLE. ``num_scale``/``den_scale`` are the decimal places of the inputs."""
    n = f"CAST(round(({num}) * {10 ** num_scale}) AS HUGEINT)"
    d = f"CAST(round(({den}) * {10 ** den_scale}) AS HUGEINT)"
    shift = 4 + den_scale - num_scale
    n_scaled = f"abs({n}) * {10 ** shift}" if shift >= 0 else f"abs({n})"
    d_scaled = f"abs({d})" if shift >= 0 else f"abs({d}) * {10 ** -shift}"
    return (
        f"(CASE WHEN ({den}) = 0 OR ({den}) IS NULL OR ({num}) IS NULL THEN NULL ELSE "
        f"CAST(sign({n}) * sign({d}) * (({n_scaled} * 2 + {d_scaled}) // (2 * {d_scaled})) AS DOUBLE) / 10000 END)"
    )


TE = """te AS (
  SELECT CAST(event_id AS INTEGER) AS time_entry_id,
         CAST(user_id AS INTEGER) AS employee_id,
         CAST(ts AS DATE) AS entry_date,
         CAST(round(value, 2) AS DECIMAL(8,2)) AS hours,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) + CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 = 0
              THEN 1073741824 ELSE 0 END AS INTEGER) AS customer_ref_id,
         CAST(CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'error' THEN 3
              WHEN 'click' THEN 4 WHEN 'purchase' THEN 5 END AS INTEGER) AS item_id,
         event_type IN ('view', 'click') AS is_billable
  FROM events)"""

ITEMS = """items AS (
  SELECT * FROM (VALUES (1, 'signup'), (2, 'view'), (3, 'error'), (4, 'click'), (5, 'purchase'))
    AS t(item_id, item_name))"""

CATS = """cats AS (
  SELECT * FROM (VALUES
    ('View', 'project_work', 'Project Work', true, true),
    ('CLICK', 'client_bd', 'Client - BD', true, true),
    ('Signup', 'internal_productive', 'Internal - Productive', true, false),
    ('Refund', 'internal_admin', 'Internal - Admin', true, false),
    ('Purchase', 'exempt', 'Exempt', false, false))
    AS t(item_name, category_code, category_name, counts_as_worked, is_client_facing))"""

EMP = """emp AS (
  SELECT CAST(c_custkey AS INTEGER) AS employee_id,
         c_name AS employee_name,
         CAST(c_nationkey AS INTEGER) AS department_id,
         DATE '2023-12-20' + c_nationkey AS hire_date,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN DATE '2023-12-25' + c_nationkey END AS release_date,
         CAST(40 + c_nationkey AS DECIMAL(10,2)) AS cost_per_hour,
         CAST(CAST(40 + c_nationkey AS DECIMAL(10,2)) * 1.5 AS DECIMAL(10,2)) AS burdened_cost_per_hour,
         CAST(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 6 ELSE 8 END AS DECIMAL(4,2)) AS standard_hours_per_day
  FROM customer)"""

PROJ = """proj AS (
  SELECT CAST(o_orderkey + 1073741824 AS INTEGER) AS project_id,
         'PRJ-' || CAST(o_orderkey AS VARCHAR) AS project_number,
         'Order ' || CAST(o_orderkey AS VARCHAR) AS project_name,
         CAST(o_custkey AS INTEGER) AS customer_id,
         substr(o_orderpriority, 1, 1) || '. ' || substr(o_orderpriority, 3) AS project_status,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS project_status_rank,
         substr(o_orderpriority, 3) AS project_status_label,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) >= 4 AS is_complete,
         CAST(o_orderdate AS DATE) AS start_date,
         CAST(o_custkey AS INTEGER) AS project_manager_id
  FROM orders)"""

CLIENTS = """clients AS (
  SELECT CAST(c_custkey AS INTEGER) AS client_id, CAST(c_custkey AS VARCHAR) AS client_number,
         c_name AS client_name, c_mktsegment = 'MACHINERY' AS is_internal
  FROM customer)"""

DEPTS = """depts AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS department_id, n.n_name AS department_name,
         r.r_name AS group_name
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

CATEGORIZED = """cte AS (
  SELECT e.time_entry_id, e.entry_date, e.employee_id, e.item_id, it.item_name,
         coalesce(c.category_code, 'unmapped') AS category_code,
         coalesce(c.category_name, 'Unmapped') AS category_name,
         coalesce(c.counts_as_worked, false) AS counts_as_worked,
         coalesce(c.is_client_facing, false) AS is_client_facing,
         p.project_id,
         coalesce(p.customer_id, CASE WHEN p.project_id IS NULL THEN e.customer_ref_id END) AS client_id,
         e.hours,
         CAST(CASE WHEN c.counts_as_worked THEN e.hours ELSE 0 END AS DECIMAL(8,2)) AS worked_hours,
         CAST(CASE WHEN c.is_client_facing THEN e.hours ELSE 0 END AS DECIMAL(8,2)) AS client_facing_hours,
         CAST(CASE WHEN c.category_code = 'project_work' THEN e.hours ELSE 0 END AS DECIMAL(8,2)) AS project_work_hours,
         CAST(CASE WHEN c.category_code = 'client_bd' THEN e.hours ELSE 0 END AS DECIMAL(8,2)) AS client_bd_hours,
         CAST(CASE WHEN c.category_code = 'internal_productive' THEN e.hours ELSE 0 END AS DECIMAL(8,2)) AS internal_productive_hours,
         CAST(CASE WHEN c.category_code = 'internal_admin' THEN e.hours ELSE 0 END AS DECIMAL(8,2)) AS internal_admin_hours,
         CAST(CASE WHEN c.category_code = 'exempt' THEN e.hours ELSE 0 END AS DECIMAL(8,2)) AS exempt_hours,
         CAST(CASE WHEN c.category_code IS NULL THEN e.hours ELSE 0 END AS DECIMAL(8,2)) AS unmapped_hours,
         CAST(e.hours * m.cost_per_hour AS DECIMAL(14,4)) AS time_cost,
         CAST(e.hours * m.burdened_cost_per_hour AS DECIMAL(14,4)) AS burdened_time_cost,
         e.is_billable
  FROM te e
  LEFT JOIN items it ON e.item_id = it.item_id
  LEFT JOIN cats c ON lower(c.item_name) = lower(it.item_name)
  LEFT JOIN proj p ON e.customer_ref_id = p.project_id
  LEFT JOIN emp m ON e.employee_id = m.employee_id)"""

CAL = """cal AS (
  SELECT CAST(d AS DATE) AS date_day,
         CAST(d AS DATE) - CAST(extract(dow FROM d) AS INTEGER) AS week_start,
         extract(isodow FROM d) < 6 AS is_weekday
  FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01',
                                      CAST((SELECT max(entry_date) FROM te) AS TIMESTAMP),
                                      INTERVAL 1 DAY)) AS d))"""

DAYS = """exempt AS (
  SELECT employee_id, entry_date, sum(exempt_hours) AS exempt_hours FROM cte GROUP BY 1, 2),
days AS (
  SELECT m.employee_id, cal.date_day, cal.week_start, cal.is_weekday,
         CAST(CASE WHEN cal.is_weekday THEN m.standard_hours_per_day ELSE 0 END AS DECIMAL(8,2)) AS standard_hours,
         CAST(coalesce(x.exempt_hours, 0) AS DECIMAL(8,2)) AS exempt_hours,
         CAST(CASE WHEN cal.is_weekday
                   THEN greatest(m.standard_hours_per_day - coalesce(x.exempt_hours, 0), 0)
                   ELSE 0 END AS DECIMAL(8,2)) AS expected_hours
  FROM emp m
  JOIN cal ON cal.date_day >= m.hire_date
          AND (m.release_date IS NULL OR cal.date_day <= m.release_date)
  LEFT JOIN exempt x ON m.employee_id = x.employee_id AND cal.date_day = x.entry_date)"""

DIM_EMP = """dim_emp AS (
  SELECT m.employee_id, m.employee_name, d.department_name,
         coalesce(d.group_name, d.department_name) AS group_name,
         m.hire_date, m.release_date,
         CASE WHEN m.release_date < (SELECT max(date_day) FROM cal) THEN 'Released' ELSE 'Current' END
           AS employment_status,
         m.standard_hours_per_day
  FROM emp m LEFT JOIN depts d ON m.department_id = d.department_id)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = (TE, ITEMS, CATS, EMP, PROJ, CATEGORIZED)

_W_LOGGED = ("worked_hours", "project_work_hours", "client_bd_hours", "internal_productive_hours",
             "internal_admin_hours", "exempt_hours")


def utilization_weekly_sql() -> str:
    logged = ", ".join(f"sum({c}) AS {c}" for c in _W_LOGGED)
    co = ", ".join(f"coalesce(l.{c}, 0) AS {c}" for c in _W_LOGGED)
    dec = ", ".join(f"CAST(CAST(w.{c} AS DECIMAL(10,2)) AS DOUBLE) AS {c}" for c in _W_LOGGED)
    return with_(*BASE, CAL, DAYS, DEPTS, DIM_EMP, f"""cap AS (
  SELECT employee_id, date_day - CAST(extract(dow FROM date_day) AS INTEGER) AS week_start,
         sum(standard_hours) AS standard_hours, sum(expected_hours) AS expected_hours
  FROM days GROUP BY 1, 2),
logged AS (
  SELECT employee_id, entry_date - CAST(extract(dow FROM entry_date) AS INTEGER) AS week_start, {logged}
  FROM cte GROUP BY 1, 2),
weeks AS (
  SELECT coalesce(c.employee_id, l.employee_id) AS employee_id,
         coalesce(c.week_start, l.week_start) AS week_start,
         coalesce(c.standard_hours, 0) AS standard_hours,
         coalesce(c.expected_hours, 0) AS expected_hours, {co}
  FROM cap c FULL OUTER JOIN logged l ON c.employee_id = l.employee_id AND c.week_start = l.week_start)""") + f"""
SELECT CAST(w.employee_id AS INTEGER) AS employee_id, e.employee_name, e.department_name, e.group_name,
       CAST(w.week_start AS DATE) AS week_start,
       CAST(CAST(w.standard_hours AS DECIMAL(10,2)) AS DOUBLE) AS standard_hours,
       CAST(CAST(w.expected_hours AS DECIMAL(10,2)) AS DOUBLE) AS expected_hours,
       {dec},
       {pct('w.worked_hours', 'w.expected_hours')} AS net_utilization_pct,
       {pct('w.project_work_hours', 'w.expected_hours')} AS project_work_pct,
       {pct('w.client_bd_hours', 'w.expected_hours')} AS client_bd_pct,
       {pct('w.internal_productive_hours + w.internal_admin_hours', 'w.expected_hours')} AS internal_pct,
       {pct('w.exempt_hours', 'w.standard_hours')} AS exempt_pct
FROM weeks w LEFT JOIN dim_emp e ON w.employee_id = e.employee_id"""


def calendar_sql() -> str:
    return with_(TE, CAL) + "SELECT date_day, week_start, is_weekday FROM cal"


def date_dimension_sql() -> str:
    return with_(TE, CAL) + """SELECT date_day, week_start,
       'Week of ' || strftime(week_start, '%Y-%m-%d') AS week_label,
       CAST(date_trunc('month', date_day) AS DATE) AS month_start,
       strftime(date_day, '%B') AS month_name,
       CAST(extract(quarter FROM date_day) AS INTEGER) AS quarter,
       CAST(extract(year FROM date_day) AS INTEGER) AS year,
       CAST(extract(dow FROM date_day) AS INTEGER) AS day_of_week,
       strftime(date_day, '%A') AS day_name,
       is_weekday
FROM cal"""


def categorized_entries_sql() -> str:
    hours = ("hours", "worked_hours", "client_facing_hours", "project_work_hours", "client_bd_hours",
             "internal_productive_hours", "internal_admin_hours", "exempt_hours", "unmapped_hours",
             "time_cost", "burdened_time_cost")
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in hours)
    return with_(*BASE) + f"""SELECT time_entry_id, entry_date, employee_id, item_id, item_name,
       category_code, category_name, counts_as_worked, is_client_facing, project_id, client_id,
       {cols}, is_billable
FROM cte"""


def employee_days_sql() -> str:
    return with_(*BASE, CAL, DAYS) + """SELECT employee_id, date_day, week_start, is_weekday,
       CAST(standard_hours AS DOUBLE) AS standard_hours, CAST(exempt_hours AS DOUBLE) AS exempt_hours,
       CAST(expected_hours AS DOUBLE) AS expected_hours
FROM days"""


def capacity_from_released_sql() -> str:
    return with_(*BASE, CAL, DAYS) + """SELECT m.employee_id, m.release_date,
       CAST(count(d.date_day) AS BIGINT) AS days_employed,
       CAST(CAST(coalesce(sum(d.expected_hours), 0) AS DECIMAL(10,2)) AS DOUBLE) AS expected_hours
FROM emp m LEFT JOIN days d ON m.employee_id = d.employee_id
WHERE m.release_date IS NOT NULL
GROUP BY m.employee_id, m.release_date"""


TX = """tx AS (
  SELECT CAST(o_orderkey AS INTEGER) AS transaction_id,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'SalesOrd' WHEN '2-HIGH' THEN 'CustInvc'
              WHEN '3-MEDIUM' THEN 'CustCred' WHEN '4-NOT SPECIFIED' THEN 'PurchOrd'
              WHEN '5-LOW' THEN 'VendAuth' END AS transaction_type,
         CASE o_orderstatus WHEN 'F' THEN 'Billed' WHEN 'O' THEN 'Pending Billing'
              WHEN 'P' THEN 'Rejected by Supervisor' END AS transaction_status
  FROM orders)"""

LINES = """lines AS (
  SELECT transaction_id, line_id, line_id = 1 AS is_mainline,
         CAST(transaction_id + 1073741824 AS INTEGER) AS entity_id
  FROM (SELECT DISTINCT CAST(l_orderkey AS INTEGER) AS transaction_id,
                        CAST(l_linenumber AS INTEGER) AS line_id FROM lineitem))"""

ACL = """acl AS (
  SELECT CAST(l_orderkey AS INTEGER) AS transaction_id, CAST(l_linenumber AS INTEGER) AS line_id,
         CAST(l_partkey AS INTEGER) AS account_id, CAST(l_extendedprice AS DECIMAL(14,2)) AS amount
  FROM lineitem)"""

ACCTS = """accts AS (
  SELECT CAST(p_partkey AS INTEGER) AS account_id,
         CASE p_type WHEN 'STANDARD' THEN '40000' WHEN 'PROMO' THEN '40110' WHEN 'ECONOMY' THEN '25000'
              WHEN 'LARGE' THEN '50100' WHEN 'SMALL' THEN '50300' WHEN 'MEDIUM' THEN '32000' END AS account_number,
         CASE p_type WHEN 'STANDARD' THEN 'Income' WHEN 'PROMO' THEN 'Income' WHEN 'ECONOMY' THEN 'DeferRevenue'
              WHEN 'LARGE' THEN 'COGS' WHEN 'SMALL' THEN 'COGS' WHEN 'MEDIUM' THEN 'Equity' END AS account_type
  FROM part)"""

CLASSES = """classes AS (
  SELECT * FROM (VALUES ('32000', 'excluded'), ('40000', 'revenue'), ('40110', 'pass_through_travel'),
    ('40120', 'pass_through_incentive'), ('50100', 'field_cost'), ('50200', 'field_cost'),
    ('50300', 'incentive_cost'), ('50400', 'travel_cost')) AS t(account_number, account_class))"""

FIN = """classified AS (
  SELECT l.transaction_id, l.line_id, l.entity_id AS project_id, p.is_complete AS project_is_complete,
         t.transaction_type, t.transaction_status, a.account_id, a.account_number, a.account_type,
         c.account_class,
         CAST(CASE WHEN a.account_type IN ('Income', 'OthIncome', 'DeferRevenue') THEN -x.amount
                   ELSE x.amount END AS DECIMAL(14,2)) AS amount,
         t.transaction_type IN ('SalesOrd', 'CustInvc', 'CustCred') AS is_revenue_document,
         coalesce(c.account_class IN ('revenue', 'pass_through_travel', 'pass_through_incentive')
                  OR a.account_type = 'DeferRevenue', false) AS is_revenue_account,
         CASE WHEN c.account_class = 'excluded' THEN 'excluded account'
              WHEN t.transaction_status = 'Rejected by Supervisor' THEN 'rejected by supervisor'
              WHEN t.transaction_type = 'PurchOrd'
                   AND t.transaction_status NOT IN ('Pending Supervisor Approval', 'Pending Billing')
                THEN 'purchase order no longer pending'
              WHEN a.account_type = 'DeferRevenue' AND t.transaction_type NOT IN ('SalesOrd', 'CustInvc', 'CustCred')
                THEN 'deferred revenue outside a sales document'
              WHEN t.transaction_type = 'VendAuth' THEN 'vendor return authorization' END AS exclusion_reason
  FROM (SELECT * FROM lines WHERE NOT is_mainline) l
  JOIN proj p ON l.entity_id = p.project_id
  JOIN tx t ON l.transaction_id = t.transaction_id
  JOIN acl x ON l.transaction_id = x.transaction_id AND l.line_id = x.line_id
  JOIN accts a ON x.account_id = a.account_id
  LEFT JOIN classes c ON a.account_number = c.account_number),
priced AS (
  SELECT *, exclusion_reason IS NOT NULL AS is_excluded,
         CASE WHEN project_is_complete THEN transaction_type IN ('CustInvc', 'CustCred')
              ELSE transaction_type = 'SalesOrd' END AS counts_toward_price
  FROM classified),
fin AS (
  SELECT *,
    CAST(CASE WHEN NOT is_excluded AND is_revenue_document AND is_revenue_account AND counts_toward_price
              THEN amount ELSE 0 END AS DECIMAL(14,2)) AS price_amount,
    CAST(CASE WHEN NOT is_excluded AND is_revenue_document AND counts_toward_price
              AND account_class IN ('pass_through_travel', 'pass_through_incentive')
              THEN amount ELSE 0 END AS DECIMAL(14,2)) AS pass_through_amount,
    CAST(CASE WHEN NOT is_excluded AND account_class = 'field_cost' THEN amount ELSE 0 END AS DECIMAL(14,2)) AS field_cost,
    CAST(CASE WHEN NOT is_excluded AND account_class = 'incentive_cost' THEN amount ELSE 0 END AS DECIMAL(14,2)) AS incentive_cost,
    CAST(CASE WHEN NOT is_excluded AND account_class = 'travel_cost' THEN amount ELSE 0 END AS DECIMAL(14,2)) AS travel_cost
  FROM priced)"""

DIM_PROJ = """dim_proj AS (
  SELECT p.project_id, p.project_number, p.project_name,
         concat_ws(' ', p.project_number, concat_ws(' : ', c.client_name, p.project_name)) AS project_display_name,
         p.customer_id AS client_id, c.client_name, p.project_status_label, p.start_date,
         CAST(NULL AS VARCHAR) AS department_name, m.employee_name AS project_lead
  FROM proj p
  LEFT JOIN clients c ON p.customer_id = c.client_id
  LEFT JOIN emp m ON p.project_manager_id = m.employee_id)"""

DIM_ITEM = """dim_item AS (
  SELECT it.item_id, it.item_name, coalesce(c.category_name, 'Unmapped') AS category_name
  FROM items it LEFT JOIN cats c ON lower(it.item_name) = lower(c.item_name))"""


def financial_lines_sql() -> str:
    return with_(*BASE, TX, LINES, ACL, ACCTS, CLASSES, FIN) + """SELECT transaction_id, line_id, project_id,
       project_is_complete, transaction_type, transaction_status, account_id, account_number, account_type,
       account_class, CAST(amount AS DOUBLE) AS amount, is_revenue_document, is_revenue_account,
       exclusion_reason, is_excluded, counts_toward_price,
       CAST(price_amount AS DOUBLE) AS price_amount, CAST(pass_through_amount AS DOUBLE) AS pass_through_amount,
       CAST(field_cost AS DOUBLE) AS field_cost, CAST(incentive_cost AS DOUBLE) AS incentive_cost,
       CAST(travel_cost AS DOUBLE) AS travel_cost
FROM fin"""


PM = """f AS (
  SELECT project_id, sum(price_amount) AS price, sum(pass_through_amount) AS pass_through_revenue,
         sum(field_cost) AS field_cost, sum(incentive_cost) AS incentive_cost, sum(travel_cost) AS travel_cost
  FROM fin GROUP BY 1),
ts AS (
  SELECT project_id, sum(hours) AS total_hours, sum(time_cost) AS time_cost,
         sum(burdened_time_cost) AS burdened_time_cost
  FROM cte WHERE project_id IS NOT NULL GROUP BY 1),
pj AS (
  SELECT d.*, coalesce(ts.total_hours, 0) AS total_hours, coalesce(ts.time_cost, 0) AS time_cost,
         coalesce(ts.burdened_time_cost, 0) AS burdened_time_cost, coalesce(f.price, 0) AS price,
         coalesce(f.pass_through_revenue, 0) AS pass_through_revenue, coalesce(f.field_cost, 0) AS field_cost,
         coalesce(f.incentive_cost, 0) AS incentive_cost, coalesce(f.travel_cost, 0) AS travel_cost
  FROM dim_proj d LEFT JOIN f ON d.project_id = f.project_id LEFT JOIN ts ON d.project_id = ts.project_id),
mg AS (
  SELECT *, price - pass_through_revenue AS net_revenue,
         price - (field_cost + incentive_cost + travel_cost + time_cost) AS project_profit,
         price - (field_cost + incentive_cost + travel_cost + burdened_time_cost) AS contribution_margin
  FROM pj),
pm AS (
  SELECT project_id, project_display_name, client_name, department_name, project_lead, project_status_label,
         start_date, CAST(total_hours AS DECIMAL(10,2)) AS total_hours,
         CAST(time_cost AS DECIMAL(14,2)) AS time_cost, CAST(burdened_time_cost AS DECIMAL(14,2)) AS burdened_time_cost,
         CAST(price AS DECIMAL(14,2)) AS price, CAST(pass_through_revenue AS DECIMAL(14,2)) AS pass_through_revenue,
         CAST(net_revenue AS DECIMAL(14,2)) AS net_revenue, CAST(field_cost AS DECIMAL(14,2)) AS field_cost,
         CAST(incentive_cost AS DECIMAL(14,2)) AS incentive_cost, CAST(travel_cost AS DECIMAL(14,2)) AS travel_cost,
         CAST(project_profit AS DECIMAL(14,2)) AS project_profit,
         CAST(contribution_margin AS DECIMAL(14,2)) AS contribution_margin,
         project_profit AS raw_profit, contribution_margin AS raw_cm, net_revenue AS raw_net
  FROM mg)"""

def project_margin_sql() -> str:
    money = ("total_hours", "time_cost", "burdened_time_cost", "price", "pass_through_revenue", "net_revenue",
             "field_cost", "incentive_cost", "travel_cost", "project_profit", "contribution_margin")
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in money)
    return with_(*MARGIN_CTES) + f"""SELECT project_id, project_display_name, client_name, department_name, project_lead,
       project_status_label, start_date, {cols},
       {pct('raw_profit', 'raw_net', 4, 2)} AS project_profit_pct,
       {pct('raw_cm', 'raw_net', 4, 2)} AS contribution_margin_pct
FROM pm"""


def margin_measures_sql() -> str:
    keys = "department_name, project_lead, client_name, project_display_name, project_status_label, project_id"
    sums = ("total_hours", "price", "travel_cost", "incentive_cost", "field_cost")
    agg = ", ".join(f"CAST(sum({c}) AS DOUBLE) AS {c}" for c in sums)
    ratio = ("CASE WHEN coalesce(CAST(sum(net_revenue) AS DOUBLE), 0) = 0 THEN NULL "
             "ELSE CAST(sum({n}) AS DOUBLE) / CAST(sum(net_revenue) AS DOUBLE) END")
    tail = (f"{agg}, {ratio.format(n='project_profit')} AS project_profit_pct, "
            f"{ratio.format(n='contribution_margin')} AS contribution_margin_pct")
    nulls = ("CAST(NULL AS VARCHAR) AS department_name, CAST(NULL AS VARCHAR) AS project_lead, "
             "CAST(NULL AS VARCHAR) AS client_name, CAST(NULL AS VARCHAR) AS project_display_name, "
             "CAST(NULL AS VARCHAR) AS project_status_label, CAST(NULL AS INTEGER) AS project_id")
    return with_(*MARGIN_CTES) + f"""SELECT {keys}, 0 AS grouping_level, {tail} FROM pm GROUP BY {keys}
UNION ALL
SELECT {nulls}, 1 AS grouping_level, {tail} FROM pm"""


def _rollup_join(rows: list[str], left: str, right: str) -> str:
    cond = " AND ".join([f"a.{r} IS NOT DISTINCT FROM b.{r}" for r in rows] + ["a.grouping_level = b.grouping_level"])
    keys = ", ".join(f"coalesce(a.{r}, b.{r}) AS {r}" for r in rows)
    return f"FROM {left} a FULL JOIN {right} b ON {cond}", keys


def _div(num: str, den: str) -> str:
    return (f"(CASE WHEN {den} IS NULL OR CAST({den} AS DOUBLE) = 0 THEN NULL "
            f"ELSE CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END)")


def utilization_rollup_sql() -> str:
    rows = ["group_name", "department_name", "employee_name", "week_start"]
    grp = "d.group_name, d.department_name, d.employee_name, dd.week_start"
    frm, keys = _rollup_join(rows, "ta", "ca")
    return with_(*BASE, CAL, DAYS, DEPTS, DIM_EMP, f"""dd AS (
  SELECT date_day, week_start FROM cal WHERE date_day BETWEEN DATE '2024-01-07' AND DATE '2024-01-27'),
ta AS (
  SELECT {grp}, CAST(GROUPING({grp}) AS INTEGER) AS grouping_level,
         sum(e.worked_hours) AS worked, sum(e.project_work_hours) AS pw, sum(e.client_bd_hours) AS bd,
         sum(e.internal_productive_hours) AS ip, sum(e.internal_admin_hours) AS ia, sum(e.exempt_hours) AS ex
  FROM cte e JOIN dd ON e.entry_date = dd.date_day LEFT JOIN dim_emp d ON e.employee_id = d.employee_id
  GROUP BY ROLLUP ({grp})),
ca AS (
  SELECT {grp}, CAST(GROUPING({grp}) AS INTEGER) AS grouping_level,
         sum(c.expected_hours) AS expected, sum(c.standard_hours) AS standard
  FROM days c JOIN dd ON c.date_day = dd.date_day LEFT JOIN dim_emp d ON c.employee_id = d.employee_id
  GROUP BY ROLLUP ({grp}))""") + f"""SELECT {keys}, coalesce(a.grouping_level, b.grouping_level) AS grouping_level,
       {_div('a.worked', 'b.expected')} AS net_utilization_pct,
       {_div('a.ex', 'b.standard')} AS exempt_pct,
       {_div('a.pw', 'b.expected')} AS project_work_pct,
       {_div('a.bd', 'b.expected')} AS client_bd_pct,
       {_div('a.ip + a.ia', 'b.expected')} AS internal_pct
{frm}"""


def client_rank_in_selection_sql() -> str:
    grp = "c.client_name, d.department_name, d.employee_name"
    return with_(*BASE, CLIENTS, CAL, DEPTS, DIM_EMP, f"""m AS (
  SELECT {grp}, CAST(GROUPING({grp}) AS INTEGER) AS grouping_level,
         sum(e.hours) AS total_hours, sum(e.client_facing_hours) AS client_hours
  FROM cte e JOIN clients c ON e.client_id = c.client_id AND c.is_internal = false
  LEFT JOIN dim_emp d ON e.employee_id = d.employee_id
  GROUP BY ROLLUP ({grp}))""") + """SELECT client_name, department_name, employee_name, grouping_level,
       CAST(total_hours AS DOUBLE) AS total_hours, CAST(client_hours AS DOUBLE) AS client_hours,
       CASE WHEN (grouping_level & 4) = 0 THEN CAST(rank() OVER (
            PARTITION BY grouping_level, department_name, employee_name, (grouping_level & 4)
            ORDER BY client_hours DESC NULLS LAST) AS INTEGER) END AS client_rank
FROM m"""


def _tasks_sql(rows: list[tuple[str, str, str]]) -> str:
    grp = ", ".join(f"{src} AS {al}" for src, al, _ in rows)
    raw = ", ".join(src for src, _, _ in rows)
    return with_(*BASE, CLIENTS, CAL, DEPTS, DIM_EMP, DIM_PROJ) + f"""SELECT {grp},
       CAST(GROUPING({raw}) AS INTEGER) AS grouping_level, CAST(sum(e.hours) AS DOUBLE) AS total_hours
FROM cte e
JOIN items it ON e.item_id = it.item_id AND it.item_name IN ('view', 'click', 'purchase')
LEFT JOIN dim_emp d ON e.employee_id = d.employee_id
LEFT JOIN dim_proj p ON e.project_id = p.project_id
GROUP BY ROLLUP ({raw})"""


def tasks_by_person_sql() -> str:
    return _tasks_sql([("p.department_name", "department_name", ""), ("p.project_display_name", "project_display_name", ""),
                       ("it.item_name", "item_name", ""), ("d.employee_name", "employee_name", "")])


def persons_by_task_sql() -> str:
    return _tasks_sql([("d.department_name", "department_name", ""), ("d.employee_name", "employee_name", ""),
                       ("it.item_name", "item_name", ""), ("p.project_display_name", "project_display_name", "")])


def client_hours_sql() -> str:
    return with_(*BASE, CLIENTS, DEPTS, "cal AS (SELECT max(entry_date) AS date_day FROM te)", DIM_EMP) + """SELECT e.client_id, c.client_name, e.employee_id, d.employee_name, d.department_name, e.entry_date,
       CAST(CAST(sum(e.hours) AS DECIMAL(10,2)) AS DOUBLE) AS total_hours,
       CAST(CAST(sum(e.client_facing_hours) AS DECIMAL(10,2)) AS DOUBLE) AS client_facing_hours
FROM cte e
JOIN clients c ON e.client_id = c.client_id AND NOT c.is_internal
LEFT JOIN dim_emp d ON e.employee_id = d.employee_id
GROUP BY 1, 2, 3, 4, 5, 6"""


def top_clients_sql() -> str:
    return with_(*BASE, CLIENTS) + """SELECT client_id, client_name,
       CAST(CAST(client_facing_hours AS DECIMAL(10,2)) AS DOUBLE) AS client_facing_hours,
       CAST(CAST(total_hours AS DECIMAL(10,2)) AS DOUBLE) AS total_hours,
       CAST(client_rank AS INTEGER) AS client_rank, client_rank <= 15 AS is_top_15
FROM (
  SELECT *, rank() OVER (ORDER BY client_facing_hours DESC NULLS FIRST, total_hours DESC NULLS FIRST) AS client_rank
  FROM (SELECT e.client_id, c.client_name, sum(e.client_facing_hours) AS client_facing_hours,
               sum(e.hours) AS total_hours
        FROM cte e JOIN clients c ON e.client_id = c.client_id AND NOT c.is_internal
        GROUP BY 1, 2))"""


def task_breakdown_sql() -> str:
    return with_(*BASE, CLIENTS, DEPTS, "cal AS (SELECT max(entry_date) AS date_day FROM te)", DIM_EMP, DIM_PROJ, DIM_ITEM) + """SELECT CAST(date_trunc('month', e.entry_date) AS DATE) AS month_start, e.employee_id,
       d.employee_name, d.department_name AS employee_department, e.project_id, p.project_display_name,
       p.department_name AS project_department, coalesce(p.client_name, c.client_name) AS client_name,
       i.item_name, i.category_name, CAST(CAST(sum(e.hours) AS DECIMAL(10,2)) AS DOUBLE) AS hours
FROM cte e
LEFT JOIN dim_emp d ON e.employee_id = d.employee_id
LEFT JOIN dim_proj p ON e.project_id = p.project_id
LEFT JOIN clients c ON e.client_id = c.client_id
LEFT JOIN dim_item i ON e.item_id = i.item_id
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10"""


MARGIN_CTES = (*BASE, TX, LINES, ACL, ACCTS, CLASSES, FIN, CLIENTS, DIM_PROJ, PM)


def oracle_sql() -> dict[str, str]:
    return {
        "utilization_rollup": utilization_rollup_sql(),
        "client_rank_in_selection": client_rank_in_selection_sql(),
        "tasks_by_person": tasks_by_person_sql(),
        "persons_by_task": persons_by_task_sql(),
        "margin_measures": margin_measures_sql(),
        "financial_lines": financial_lines_sql(),
        "project_margin": project_margin_sql(),
        "client_hours": client_hours_sql(),
        "maintained_utilization": utilization_weekly_sql(),
        "maintained_client_hours": client_hours_sql(),
        "maintained_margin": project_margin_sql(),
        "top_clients": top_clients_sql(),
        "task_breakdown": task_breakdown_sql(),
        "calendar": calendar_sql(),
        "date_dimension": date_dimension_sql(),
        "categorized_entries": categorized_entries_sql(),
        "employee_days": employee_days_sql(),
        "employee_days_holidays": f"SELECT * FROM ({employee_days_sql()}) WHERE day(date_day) % 10 <> 5",
        "utilization_weekly": utilization_weekly_sql(),
        "capacity_from_released": capacity_from_released_sql(),
    }
