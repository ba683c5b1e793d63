"""Model tests with the literal cases of the reference's SQL unit tests."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import as_float, frame
from ledgerflow.plans import intermediate, reporting
from ledgerflow.sources import seeds

TE = ("time_entry_id int, employee_id int, entry_date date, hours decimal(8,2), customer_ref_id int, "
      "item_id int, department_id int, memo string, is_billable boolean")


def test_calendar_weeks_start_on_sunday(spark):
    te = frame(spark, [], TE)
    rows = intermediate.calendar(te, "2026-03-06", "2026-03-09").orderBy("date_day").collect()
    got = [(str(r.date_day), str(r.week_start), r.is_weekday) for r in rows]
    assert got == [
        ("2026-03-06", "2026-03-01", True),
        ("2026-03-07", "2026-03-01", False),
        ("2026-03-08", "2026-03-08", False),
        ("2026-03-09", "2026-03-08", True),
    ]


def test_calendar_ends_on_latest_logged_day(spark):
    te = frame(spark, [{"time_entry_id": 1, "entry_date": "2026-08-28"}, {"time_entry_id": 2, "entry_date": "2026-08-31"}], TE)
    days = [str(r.date_day) for r in intermediate.calendar(te, "2026-08-30").orderBy("date_day").collect()]
    assert days == ["2026-08-30", "2026-08-31"]


def test_calendar_empty_when_start_after_end(spark):
    te = frame(spark, [{"time_entry_id": 1, "entry_date": "2026-01-01"}], TE)
    assert intermediate.calendar(te, "2026-02-01").count() == 0


def categorize(spark):
    entries = frame(spark, [
        {"time_entry_id": 1, "employee_id": 10, "entry_date": "2026-03-02", "hours": 3, "customer_ref_id": 500, "item_id": 1},
        {"time_entry_id": 2, "employee_id": 10, "entry_date": "2026-03-02", "hours": 2, "customer_ref_id": 900, "item_id": 2},
        {"time_entry_id": 3, "employee_id": 10, "entry_date": "2026-03-02", "hours": 1.5, "item_id": 3},
        {"time_entry_id": 4, "employee_id": 10, "entry_date": "2026-03-03", "hours": 8, "item_id": 4},
        {"time_entry_id": 5, "employee_id": 10, "entry_date": "2026-03-04", "hours": 0.5, "item_id": 5},
        {"time_entry_id": 6, "employee_id": 10, "entry_date": "2026-03-04", "hours": 1.25, "item_id": 6},
    ], TE)
    items = frame(spark, [{"item_id": i, "item_name": n} for i, n in
                          [(1, "Project Time"), (2, "Business Development"), (3, "TRAINING"), (4, "Holiday"),
                           (5, "Misc Time"), (6, "Admin")]], "item_id int, item_name string")
    cats = seeds.time_categories(spark)
    projects = frame(spark, [{"project_id": 500, "customer_id": 901}], "project_id int, customer_id int")
    emps = frame(spark, [{"employee_id": 10, "cost_per_hour": 50, "burdened_cost_per_hour": 65}],
                 "employee_id int, cost_per_hour decimal(10,2), burdened_cost_per_hour decimal(10,2)")
    return intermediate.categorize_time(entries, items, cats, projects, emps)


def test_time_entries_are_categorized_bucketed_and_costed(spark):
    rows = {r.time_entry_id: r for r in categorize(spark).collect()}
    expect = {
        1: ("project_work", 500, 901, 3, 3, 3, 0, 0, 0, 0, 0, 150, 195),
        2: ("client_bd", None, 900, 2, 2, 0, 2, 0, 0, 0, 0, 100, 130),
        3: ("internal_productive", None, None, 1.5, 0, 0, 0, 1.5, 0, 0, 0, 75, 97.5),
        4: ("exempt", None, None, 0, 0, 0, 0, 0, 0, 8, 0, 400, 520),
        5: ("unmapped", None, None, 0, 0, 0, 0, 0, 0, 0, 0.5, 25, 32.5),
        6: ("internal_admin", None, None, 1.25, 0, 0, 0, 0, 1.25, 0, 0, 62.5, 81.25),
    }
    cols = ["worked_hours", "client_facing_hours", "project_work_hours", "client_bd_hours",
            "internal_productive_hours", "internal_admin_hours", "exempt_hours", "unmapped_hours",
            "time_cost", "burdened_time_cost"]
    for k, (code, pid, cid, *nums) in expect.items():
        r = rows[k]
        assert (r.category_code, r.project_id, r.client_id) == (code, pid, cid)
        assert [as_float(r[c]) for c in cols] == [float(n) for n in nums], k


def test_expected_hours_follow_employment_weekdays_and_exempt_time(spark):
    emps = frame(spark, [
        {"employee_id": 1, "hire_date": "2026-03-03", "standard_hours_per_day": 8},
        {"employee_id": 2, "hire_date": "2020-01-01", "release_date": "2026-03-04", "standard_hours_per_day": 6},
    ], "employee_id int, hire_date date, release_date date, standard_hours_per_day decimal(4,2)")
    cal = frame(spark, [{"date_day": f"2026-03-0{d}"} for d in range(2, 9)], "date_day date")
    cat = frame(spark, [
        {"time_entry_id": 1, "employee_id": 1, "entry_date": "2026-03-04", "exempt_hours": 4},
        {"time_entry_id": 2, "employee_id": 1, "entry_date": "2026-03-04", "exempt_hours": 0},
        {"time_entry_id": 3, "employee_id": 1, "entry_date": "2026-03-05", "exempt_hours": 10},
        {"time_entry_id": 4, "employee_id": 1, "entry_date": "2026-03-07", "exempt_hours": 8},
        {"time_entry_id": 5, "employee_id": 2, "entry_date": "2026-03-03", "exempt_hours": 6},
    ], "time_entry_id int, employee_id int, entry_date date, exempt_hours decimal(8,2)")
    got = sorted(
        (r.employee_id, str(r.date_day), float(r.standard_hours), float(r.exempt_hours), float(r.expected_hours))
        for r in intermediate.employee_days(emps, cal, cat).collect()
    )
    assert got == [
        (1, "2026-03-03", 8, 0, 8), (1, "2026-03-04", 8, 4, 4), (1, "2026-03-05", 8, 10, 0),
        (1, "2026-03-06", 8, 0, 8), (1, "2026-03-07", 0, 8, 0), (1, "2026-03-08", 0, 0, 0),
        (2, "2026-03-02", 6, 0, 6), (2, "2026-03-03", 6, 6, 0), (2, "2026-03-04", 6, 0, 6),
    ]


def test_project_financial_lines_apply_the_margin_rules(spark):
    projects = frame(spark, [{"project_id": 500, "is_complete": True}, {"project_id": 600, "is_complete": False}],
                     "project_id int, is_complete boolean")
    tx = [(1, "SalesOrd", "Pending Billing"), (2, "CustInvc", "Open"), (3, "CustCred", "Fully Applied"),
          (4, "SalesOrd", "Pending Billing"), (5, "CustInvc", "Open"), (6, "VendBill", "Open"),
          (7, "PurchOrd", "Pending Billing"), (8, "PurchOrd", "Fully Billed"), (9, "ExpRept", "Rejected by Supervisor"),
          (10, "ExpRept", "Approved by Accounting"), (11, "VendAuth", "Pending Return"),
          (12, "Journal", "Approved for Posting"), (13, "Journal", "Approved for Posting"), (14, "CustInvc", "Open"),
          (15, "PurchOrd", "Pending Supervisor Approval")]
    transactions = frame(spark, [{"transaction_id": i, "transaction_type": t, "transaction_status": s} for i, t, s in tx],
                         "transaction_id int, transaction_date date, document_number string, transaction_type string, "
                         "transaction_type_name string, transaction_status string")
    lines_rows = [(1, 0, True, 77)] + [(t, l, False, p) for t, l, p in [
        (1, 1, 500), (2, 1, 500), (2, 2, 500), (3, 1, 500), (4, 1, 600), (4, 2, 600), (5, 1, 600), (6, 1, 500),
        (6, 2, 500), (7, 1, 500), (8, 1, 500), (9, 1, 500), (10, 1, 500), (11, 1, 500), (12, 1, 500), (13, 1, 500),
        (14, 1, 500), (15, 1, 500)]]
    lines = frame(spark, [{"transaction_id": t, "line_id": l, "is_mainline": m, "entity_id": e} for t, l, m, e in lines_rows],
                  "transaction_id int, line_id int, is_mainline boolean, entity_id int")
    acc_rows = [(1, 0, 102, 10000), (1, 1, 106, -10000), (2, 1, 106, -6000), (2, 2, 107, -500), (3, 1, 106, 1000),
                (4, 1, 106, -8000), (4, 2, 108, -700), (5, 1, 106, -3000), (6, 1, 110, 2000), (6, 2, 111, 300),
                (7, 1, 110, 400), (8, 1, 110, 999), (9, 1, 112, 250), (10, 1, 112, 200), (11, 1, 110, -100),
                (12, 1, 105, 5000), (13, 1, 104, 800), (14, 1, 104, -300), (15, 1, 109, 600)]
    accounting = frame(spark, [{"transaction_id": t, "line_id": l, "account_id": a, "amount": m} for t, l, a, m in acc_rows],
                       "transaction_id int, line_id int, account_id int, amount decimal(14,2)")
    accts = [(102, "11000", "AcctRec"), (104, None, "DeferRevenue"), (105, "32000", "Equity"), (106, "40000", "Income"),
             (107, "40110", "Income"), (108, "40120", "Income"), (109, "50100", "COGS"), (110, "50200", "COGS"),
             (111, "50300", "COGS"), (112, "50400", "COGS")]
    accounts = frame(spark, [{"account_id": i, "account_number": n, "account_type": t} for i, n, t in accts],
                     "account_id int, account_number string, account_name string, account_type string")
    out = intermediate.project_financial_lines(lines, projects, transactions, accounting, accounts, seeds.account_classes(spark))
    got = {(r.transaction_id, r.line_id): (r.project_id, float(r.amount), r.exclusion_reason, float(r.price_amount),
                                           float(r.pass_through_amount), float(r.field_cost), float(r.incentive_cost),
                                           float(r.travel_cost)) for r in out.collect()}
    expect = {
        (1, 1): (500, 10000, None, 0, 0, 0, 0, 0), (2, 1): (500, 6000, None, 6000, 0, 0, 0, 0),
        (2, 2): (500, 500, None, 500, 500, 0, 0, 0), (3, 1): (500, -1000, None, -1000, 0, 0, 0, 0),
        (4, 1): (600, 8000, None, 8000, 0, 0, 0, 0), (4, 2): (600, 700, None, 700, 700, 0, 0, 0),
        (5, 1): (600, 3000, None, 0, 0, 0, 0, 0), (6, 1): (500, 2000, None, 0, 0, 2000, 0, 0),
        (6, 2): (500, 300, None, 0, 0, 0, 300, 0), (7, 1): (500, 400, None, 0, 0, 400, 0, 0),
        (8, 1): (500, 999, "purchase order no longer pending", 0, 0, 0, 0, 0),
        (9, 1): (500, 250, "rejected by supervisor", 0, 0, 0, 0, 0), (10, 1): (500, 200, None, 0, 0, 0, 0, 200),
        (11, 1): (500, -100, "vendor return authorization", 0, 0, 0, 0, 0),
        (12, 1): (500, 5000, "excluded account", 0, 0, 0, 0, 0),
        (13, 1): (500, -800, "deferred revenue outside a sales document", 0, 0, 0, 0, 0),
        (14, 1): (500, 300, None, 300, 0, 0, 0, 0), (15, 1): (500, 600, None, 0, 0, 600, 0, 0),
    }
    assert got == expect


def test_weekly_utilization_divides_by_expected_hours(spark):
    cap = frame(spark, [
        {"employee_id": 1, "date_day": f"2026-03-0{d}", "standard_hours": s, "expected_hours": e}
        for d, s, e in [(2, 8, 8), (3, 8, 8), (4, 8, 4), (5, 8, 0), (6, 8, 8), (7, 0, 0)]
    ] + [{"employee_id": 2, "date_day": "2026-03-08", "standard_hours": 0, "expected_hours": 0}],
        "employee_id int, date_day date, standard_hours decimal(8,2), expected_hours decimal(8,2)")
    cols = ["worked_hours", "project_work_hours", "client_bd_hours", "internal_productive_hours",
            "internal_admin_hours", "exempt_hours"]
    data = [(1, 1, "2026-03-02", 8, 8, 0, 0, 0, 0), (2, 1, "2026-03-03", 8, 4, 4, 0, 0, 0),
            (3, 1, "2026-03-04", 4, 0, 0, 3, 1, 4), (4, 1, "2026-03-05", 0, 0, 0, 0, 0, 10),
            (5, 1, "2026-03-06", 8, 6, 0, 0, 2, 0), (6, 1, "2026-03-07", 2, 2, 0, 0, 0, 0),
            (7, 2, "2026-03-08", 3, 3, 0, 0, 0, 0)]
    entries = frame(spark, [dict(zip(["time_entry_id", "employee_id", "entry_date", *cols], r)) for r in data],
                    "time_entry_id int, employee_id int, entry_date date, " + ", ".join(f"{c} decimal(8,2)" for c in cols))
    dim = frame(spark, [{"employee_id": 1, "employee_name": "A", "department_name": "Consumer Group", "group_name": "Account Team"},
                        {"employee_id": 2, "employee_name": "B", "department_name": "Operations", "group_name": "Operations"}],
                "employee_id int, employee_name string, department_name string, group_name string")
    rows = {r.employee_id: r for r in reporting.utilization_weekly(cap, entries, dim).collect()}
    a = rows[1]
    assert str(a.week_start) == "2026-03-01" and a.group_name == "Account Team"
    assert [float(a[c]) for c in ("standard_hours", "expected_hours", *cols)] == [40, 28, 30, 20, 4, 3, 3, 14]
    assert [float(a[c]) for c in ("net_utilization_pct", "project_work_pct", "client_bd_pct", "internal_pct", "exempt_pct")] == [
        1.0714, 0.7143, 0.1429, 0.2143, 0.35]
    b = rows[2]
    assert str(b.week_start) == "2026-03-08" and float(b.worked_hours) == 3
    assert b.net_utilization_pct is None and b.exempt_pct is None


def test_hours_summed_before_rates_give_the_same_costs(spark):
    """A project's time from (reference, employee) sums equals the sum over costed entries:
    references to clients, NULL references, people without a rate, NULL hours."""
    entries = frame(spark, [
        {"time_entry_id": n, "employee_id": e, "customer_ref_id": ref, "hours": h}
        for n, (e, ref, h) in enumerate([(1, 500, 7.25), (1, 500, 0.33), (2, 500, 3.1), (1, 600, 2), (3, 600, 1.5), (9, 600, 1),
                                         (None, 600, 4), (1, 10, 8), (2, None, 5), (2, 500, None), (3, 700, 2)])], TE)
    projects = frame(spark, [{"project_id": p, "customer_id": 10} for p in (500, 600, 700, 800)], "project_id int, customer_id int")
    people = frame(spark, [{"employee_id": 1, "cost_per_hour": 33.33, "burdened_cost_per_hour": 49.99},
                           {"employee_id": 2, "cost_per_hour": 20.01, "burdened_cost_per_hour": None},
                           {"employee_id": 3, "cost_per_hour": None, "burdened_cost_per_hour": None}],
                   "employee_id int, cost_per_hour decimal(10,2), burdened_cost_per_hour decimal(10,2)")
    costed = intermediate.cost_time(intermediate.resolve_references(entries, projects), people)
    want, got = reporting.project_time(costed), reporting.project_time_by_rate(entries, projects, people)
    assert got.schema == want.schema
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 3


def test_project_margin_nets_out_pass_through_revenue(spark):
    dim = frame(spark, [{"project_id": 500, "project_display_name": "100051 North : Tracker", "project_status_label": "Closed"},
                        {"project_id": 600, "project_display_name": "100058 Blue : Interviews", "project_status_label": "Awarded"}],
                "project_id int, project_display_name string, client_name string, department_name string, "
                "project_lead string, project_status_label string, start_date date")
    money = "price_amount decimal(14,2), pass_through_amount decimal(14,2), field_cost decimal(14,2), incentive_cost decimal(14,2), travel_cost decimal(14,2)"
    fin = frame(spark, [
        {"project_id": 500, "price_amount": 6000, "pass_through_amount": 0, "field_cost": 0, "incentive_cost": 0, "travel_cost": 0},
        {"project_id": 500, "price_amount": 500, "pass_through_amount": 500, "field_cost": 0, "incentive_cost": 0, "travel_cost": 0},
        {"project_id": 500, "price_amount": 0, "pass_through_amount": 0, "field_cost": 2400, "incentive_cost": 300, "travel_cost": 200},
    ], "project_id int, " + money)
    ent = frame(spark, [{"time_entry_id": 1, "project_id": 500, "hours": 12, "time_cost": 600, "burdened_time_cost": 780},
                        {"time_entry_id": 2, "project_id": 500, "hours": 8, "time_cost": 400, "burdened_time_cost": 520},
                        {"time_entry_id": 3, "project_id": None, "hours": 8, "time_cost": 400, "burdened_time_cost": 520}],
                "time_entry_id int, project_id int, hours decimal(8,2), time_cost decimal(14,4), burdened_time_cost decimal(14,4)")
    rows = {r.project_id: r for r in reporting.project_margin(dim, fin, ent).collect()}
    a = rows[500]
    assert [float(a[c]) for c in ("total_hours", "time_cost", "burdened_time_cost", "price", "pass_through_revenue",
                                  "net_revenue", "field_cost", "incentive_cost", "travel_cost", "project_profit",
                                  "project_profit_pct", "contribution_margin", "contribution_margin_pct")] == [
        20, 1000, 1300, 6500, 500, 6000, 2400, 300, 200, 2600, 0.4333, 2300, 0.3833]
    b = rows[600]
    assert float(b.price) == 0 and b.project_profit_pct is None and b.contribution_margin_pct is None


def test_top_clients_rank_external_clients(spark):
    ent = frame(spark, [{"time_entry_id": 1, "client_id": 1, "hours": 10, "client_facing_hours": 10},
                        {"time_entry_id": 2, "client_id": 2, "hours": 6, "client_facing_hours": 5},
                        {"time_entry_id": 3, "client_id": 3, "hours": 50, "client_facing_hours": 50},
                        {"time_entry_id": 4, "client_id": 4, "hours": 3, "client_facing_hours": 0},
                        {"time_entry_id": 5, "client_id": None, "hours": 40, "client_facing_hours": 0}],
                "time_entry_id int, client_id int, hours decimal(8,2), client_facing_hours decimal(8,2)")
    cli = frame(spark, [{"client_id": 1, "client_name": "North", "is_internal": False},
                        {"client_id": 2, "client_name": "Blue", "is_internal": False},
                        {"client_id": 3, "client_name": "Ourselves", "is_internal": True},
                        {"client_id": 4, "client_name": "Corvid", "is_internal": False}],
                "client_id int, client_name string, is_internal boolean")
    got = sorted((r.client_id, float(r.client_facing_hours), float(r.total_hours), r.client_rank, r.is_top_15)
                 for r in reporting.top_clients(ent, cli).collect())
    assert got == [(1, 10, 10, 1, True), (2, 5, 6, 2, True), (4, 0, 3, 3, True)]


def test_top_clients_ties_share_a_rank_and_all_flagged(spark):
    rows = [{"time_entry_id": i, "client_id": i % 20, "hours": 1, "client_facing_hours": 1 if i % 20 < 18 else 0}
            for i in range(40)]
    ent = frame(spark, rows, "time_entry_id int, client_id int, hours decimal(8,2), client_facing_hours decimal(8,2)")
    cli = frame(spark, [{"client_id": i, "client_name": f"c{i}", "is_internal": False} for i in range(20)],
                "client_id int, client_name string, is_internal boolean")
    out = reporting.top_clients(ent, cli, n=15).collect()
    ranks = sorted(r.client_rank for r in out)
    assert ranks == [1] * 18 + [19, 19]
    assert sum(r.is_top_15 for r in out) == 18  # ties: more than 15 clients qualify


def test_reporting_contract_redacts_rates(spark):
    df = categorize(spark)
    published = reporting.publish("fct_time_entries", df)
    assert not set(reporting.REDACTED_COLUMNS) & set(published.columns)
    assert published.schema["hours"].dataType.simpleString() == "decimal(8,2)"
