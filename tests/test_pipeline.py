"""End to end: ERP-shaped raw records -> load (run log, snapshots) -> model DAG ->
weekly utilization, checked against a plain-Python oracle."""

import datetime as dt
import random
import tempfile
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators.infer import infer_schema
from ledgerflow.operators.load import load_job, read_runs, read_table
from ledgerflow.plans import models
from ledgerflow.sources.records import records_from_python
from ledgerflow.sources.seeds import TIME_CATEGORIES
from ledgerflow.spec import IncrementalSpec, JobSpec, ModelParams

START = dt.date(2026, 3, 1)
FMT = "%Y-%m-%d %H:%M:%S"
ITEM_NAMES = ["Project Time", "Business Development", "Training", "Admin", "Holiday", "Misc Time"]


def raw_data(seed=7):
    rng = random.Random(seed)
    employees = []
    for i in range(1, 7):
        hire = START + dt.timedelta(days=rng.choice([-400, -10, 3]))
        release = None
        if i == 5:
            release = START + dt.timedelta(days=9)  # mid-window release
        if i == 6:
            release = START - dt.timedelta(days=5)  # released before the window
        rec = {"id": str(i), "entityid": f"E{i}", "firstname": "f", "lastname": "l", "email": f"e{i}@x",
               "department": str(1 + i % 2), "title": "t", "isinactive": "F", "hiredate": hire.isoformat(),
               "laborcost": "50.00", "custentity_burdened_cost": "65.50",
               "lastmodifieddate": "2026-01-01 00:00:00"}
        if i % 3 == 0:
            rec["custentity_hours_per_day"] = "6.00"
        if release:
            rec["releasedate"] = release.isoformat()
        employees.append(rec)
    items = [{"id": str(k + 1), "itemid": n, "itemtype": "Service", "isinactive": "F"} for k, n in enumerate(ITEM_NAMES)]
    departments = [{"id": "1", "name": "Consumer Group", "isinactive": "F"}, {"id": "2", "name": "Operations", "isinactive": "F"}]
    entries = []
    for n in range(1, 241):
        day = START + dt.timedelta(days=rng.randrange(0, 21))
        entries.append({"id": str(n), "employee": str(rng.randrange(1, 7)), "trandate": day.isoformat(),
                        "hours": f"{rng.choice([0.25, 0.5, 1, 1.5, 2, 4, 8, 10])}", "item": str(rng.randrange(1, 7)),
                        "department": "1", "isbillable": rng.choice(["T", "F"]),
                        "lastmodifieddate": f"{day.isoformat()} 12:00:00"})
    return employees, items, departments, entries


def oracle_weekly(employees, items, entries, last_day):
    cat = {n.lower(): (code, worked) for n, code, _, worked, _ in TIME_CATEGORIES}
    item_name = {r["id"]: r["itemid"] for r in items}
    std = {e["id"]: Decimal(e.get("custentity_hours_per_day") or "8") for e in employees}
    logged = defaultdict(lambda: defaultdict(Decimal))
    exempt_day = defaultdict(Decimal)
    for e in entries:
        code, worked = cat.get(item_name[e["item"]].lower(), (None, False))
        h = Decimal(e["hours"])
        day = dt.date.fromisoformat(e["trandate"])
        wk = day - dt.timedelta(days=(day.isoweekday() % 7))
        key = (int(e["employee"]), wk)
        logged[key]["worked"] += h if worked else 0
        logged[key]["exempt"] += h if code == "exempt" else 0
        if code == "exempt":
            exempt_day[(e["employee"], day)] += h
    cap = defaultdict(lambda: defaultdict(Decimal))
    for emp in employees:
        hire = dt.date.fromisoformat(emp["hiredate"])
        release = dt.date.fromisoformat(emp["releasedate"]) if "releasedate" in emp else None
        d = START
        while d <= last_day:
            if d >= hire and (release is None or d <= release):
                weekday = d.isoweekday() < 6
                wk = d - dt.timedelta(days=(d.isoweekday() % 7))
                s = std[emp["id"]] if weekday else Decimal(0)
                ex = exempt_day[(emp["id"], d)]
                cap[(int(emp["id"]), wk)]["standard"] += s
                cap[(int(emp["id"]), wk)]["expected"] += max(std[emp["id"]] - ex, Decimal(0)) if weekday else 0
            d += dt.timedelta(days=1)
    out = {}
    for key in set(cap) | set(logged):
        expected = cap[key]["expected"] if key in cap else Decimal(0)
        worked = logged[key]["worked"] if key in logged else Decimal(0)
        pct = None if expected == 0 else (worked / expected).quantize(Decimal("0.0001"), ROUND_HALF_UP)
        out[key] = (float(expected), float(worked), None if pct is None else float(pct))
    return out


@pytest.fixture(scope="module")
def pipeline(spark):
    employees, items, departments, entries = raw_data()
    wh = tempfile.mkdtemp(prefix="wh-pipe-", dir="/tmp")
    inc = IncrementalSpec("lastmodifieddate", "2025-01-01 00:00:00", FMT)

    def load(name, recs, keys=("id",), incremental=None):
        spec = JobSpec("erp", name, keys, incremental)
        schema = infer_schema(records_from_python(spark, recs), spec, checkpoint=False)
        return load_job(spark, records_from_python(spark, recs), spec, schema, wh)

    load("employees", employees, incremental=inc)
    load("time_entries", entries, incremental=inc)
    load("departments", departments)
    load("items", items)
    # a second full-refresh run without item 6: it was deleted upstream
    load("items", [r for r in items if r["id"] != "6"])
    raw = {n: read_table(spark, wh, "erp", n) for n in ("employees", "time_entries", "departments", "items")}
    empty = spark.createDataFrame([], "id string")
    for n in ("accounts", "customers", "projects", "transactions", "transaction_lines", "transaction_accounting_lines"):
        raw[n] = empty
    runs = read_runs(spark, wh, "erp")
    return employees, items, entries, raw, runs


def test_snapshot_drops_rows_not_restamped(spark, pipeline):
    *_, raw, runs = pipeline
    stg = models.staging.stg_items(raw["items"], runs)
    assert sorted(r.item_id for r in stg.collect()) == [1, 2, 3, 4, 5]
    assert raw["items"].count() == 6  # the raw table keeps the old row, stamped by the old run


def test_weekly_utilization_equals_python_oracle(spark, pipeline):
    employees, items, entries, raw, runs = pipeline
    # the deleted item maps nothing anyway ("Misc Time" is not a category)
    m = models.build(spark, {k: v for k, v in raw.items()} | {
        "accounts": spark.createDataFrame([], "id string, acctnumber string, fullname string, accttype string, isinactive string, _run_id string"),
        "customers": spark.createDataFrame([], "id string, entityid string, companyname string, email string, phone string, isinactive string, datecreated string, lastmodifieddate string"),
        "projects": spark.createDataFrame([], "id string, entityid string, companyname string, parent string, custentity_project_status string, startdate string, projectedenddate string, department string, projectmanager string, isinactive string, lastmodifieddate string"),
        "transactions": spark.createDataFrame([], "id string, tranid string, type string, status string, entity string, currency string, foreigntotal string, memo string, trandate string, lastmodifieddate string"),
        "transaction_lines": spark.createDataFrame([], "transaction string, id string, linesequencenumber string, mainline string, entity string, item string, memo string, foreignamount string, _run_id string"),
        "transaction_accounting_lines": spark.createDataFrame([], "transaction string, transactionline string, account string, amount string, posting string, _run_id string"),
    }, runs, ModelParams(calendar_start=START.isoformat()))
    last_day = max(dt.date.fromisoformat(e["trandate"]) for e in entries)
    expect = oracle_weekly(employees, items, entries, last_day)
    got = {(r.employee_id, r.week_start): (float(r.expected_hours), float(r.worked_hours),
                                            None if r.net_utilization_pct is None else float(r.net_utilization_pct))
           for r in m["rpt_utilization_weekly"].collect()}
    assert got == expect
    assert m["reporting_fct_time_entries"].count() == len(entries)
    statuses = {r.employee_id: r.employment_status for r in m["dim_employee"].collect()}
    assert statuses[6] == "Released" and statuses[1] == "Current"
