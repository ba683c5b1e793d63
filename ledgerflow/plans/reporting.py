"""Reporting models (R6-R10) and the contracted reporting views.

Decimal arithmetic follows warehouse NUMERIC semantics: sums stay exact decimals,
ratios are ``round(n / nullif(d, 0), 4)`` (HALF_UP), outputs carry contracted types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.scalars import safe_ratio, week_start
from ledgerflow.operators.ranking import global_rank
from ledgerflow.plans.contracts import CONTRACTS

_LOGGED = (
    "worked_hours",
    "project_work_hours",
    "client_bd_hours",
    "internal_productive_hours",
    "internal_admin_hours",
    "exempt_hours",
)


def _dec(col: str | F.Column, p: int, s: int) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(f"decimal({p},{s})")


def utilization_weekly(capacity: DataFrame, entries: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """Utilization per employee per Sunday-start week.

    Both facts are aggregated to (employee, week) first (partial aggregation, so a hot
    employee combines map-side), then drill-across by full outer join on the two keys.
    """
    cap = capacity.groupBy(
        "employee_id", week_start(F.col("date_day")).alias("week_start")
    ).agg(
        F.sum("standard_hours").alias("standard_hours"),
        F.sum("expected_hours").alias("expected_hours"),
    )
    logged = entries.groupBy(
        "employee_id", week_start(F.col("entry_date")).alias("week_start")
    ).agg(*[F.sum(c).alias(c) for c in _LOGGED])
    weeks = cap.join(logged, ["employee_id", "week_start"], "full").select(
        "employee_id",
        "week_start",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("standard_hours", "expected_hours", *_LOGGED)],
    )
    emp = dim_employee.select("employee_id", "employee_name", "department_name", "group_name")
    w = weeks.join(emp, "employee_id", "left")
    expected = F.col("expected_hours")
    return w.select(
        F.col("employee_id").cast("int").alias("employee_id"),
        F.col("employee_name").cast("string").alias("employee_name"),
        F.col("department_name").cast("string").alias("department_name"),
        F.col("group_name").cast("string").alias("group_name"),
        F.col("week_start").cast("date").alias("week_start"),
        _dec("standard_hours", 10, 2).alias("standard_hours"),
        _dec("expected_hours", 10, 2).alias("expected_hours"),
        *[_dec(c, 10, 2).alias(c) for c in _LOGGED[:-1]],
        _dec("exempt_hours", 10, 2).alias("exempt_hours"),
        _dec(safe_ratio(F.col("worked_hours"), expected), 9, 4).alias("net_utilization_pct"),
        _dec(safe_ratio(F.col("project_work_hours"), expected), 9, 4).alias("project_work_pct"),
        _dec(safe_ratio(F.col("client_bd_hours"), expected), 9, 4).alias("client_bd_pct"),
        _dec(
            safe_ratio(F.col("internal_productive_hours") + F.col("internal_admin_hours"), expected), 9, 4
        ).alias("internal_pct"),
        _dec(safe_ratio(F.col("exempt_hours"), F.col("standard_hours")), 9, 4).alias("exempt_pct"),
    )


def project_time(entries: DataFrame) -> DataFrame:
    """Hours and cost per project (A5) of entries that carry their project and cost."""
    return entries.filter(F.col("project_id").isNotNull()).groupBy("project_id").agg(
        F.sum("hours").alias("total_hours"),
        F.sum("time_cost").alias("time_cost"),
        F.sum("burdened_time_cost").alias("burdened_time_cost"),
    )


def project_time_by_rate(entries: DataFrame, projects: DataFrame, employees: DataFrame) -> DataFrame:
    """The same sums from plain entries: hours are summed per (reference, employee) before
    rates and projects are joined, so no entry crosses a join. An hour is a hundredth and a
    rate a cent, so hours x rate is exact in four digits and the sum of products is the
    product of the sum. A reference that names no project (J10) is left out."""
    spent = entries.groupBy("customer_ref_id", "employee_id").agg(F.sum("hours").alias("hours"))
    p = projects.select("project_id")
    on_project = spent.join(p, spent["customer_ref_id"] == p["project_id"])
    emp = employees.select(F.col("employee_id").alias("__emp"), "cost_per_hour", "burdened_cost_per_hour")
    costed = on_project.join(emp, on_project["employee_id"] == F.col("__emp"), "left")
    return costed.groupBy("project_id").agg(
        _dec(F.sum("hours"), 18, 2).alias("total_hours"),
        *[_dec(F.sum(F.col("hours") * F.col(rate)), 24, 4).alias(name)
          for rate, name in (("cost_per_hour", "time_cost"), ("burdened_cost_per_hour", "burdened_time_cost"))],
    )


def project_margin(dim_project: DataFrame, financials: DataFrame, entries: DataFrame) -> DataFrame:
    """Project contribution margin (R7) from entries that carry their project and cost."""
    return project_margin_from(dim_project, financials, project_time(entries))


def project_margin_from(dim_project: DataFrame, financials: DataFrame, spent: DataFrame) -> DataFrame:
    """Project contribution margin (R7): each fact pre-aggregated per project, then left
    joined to the project dimension so neither fact fans out the other (J14)."""
    fin = financials.groupBy("project_id").agg(
        F.sum("price_amount").alias("price"),
        F.sum("pass_through_amount").alias("pass_through_revenue"),
        F.sum("field_cost").alias("field_cost"),
        F.sum("incentive_cost").alias("incentive_cost"),
        F.sum("travel_cost").alias("travel_cost"),
    )
    measures = ("total_hours", "time_cost", "burdened_time_cost", "price", "pass_through_revenue",
                "field_cost", "incentive_cost", "travel_cost")
    projects = (
        dim_project.join(fin, "project_id", "left")
        .join(spent, "project_id", "left")
        .select("*")
    )
    for m in measures:
        projects = projects.withColumn(m, F.coalesce(F.col(m), F.lit(0)))
    costs = F.col("field_cost") + F.col("incentive_cost") + F.col("travel_cost")
    margins = (
        projects.withColumn("net_revenue", F.col("price") - F.col("pass_through_revenue"))
        .withColumn("project_profit", F.col("price") - (costs + F.col("time_cost")))
        .withColumn("contribution_margin", F.col("price") - (costs + F.col("burdened_time_cost")))
    )
    return margins.select(
        F.col("project_id").cast("int").alias("project_id"),
        F.col("project_display_name").cast("string").alias("project_display_name"),
        F.col("client_name").cast("string").alias("client_name"),
        F.col("department_name").cast("string").alias("department_name"),
        F.col("project_lead").cast("string").alias("project_lead"),
        F.col("project_status_label").cast("string").alias("project_status_label"),
        F.col("start_date").cast("date").alias("start_date"),
        _dec("total_hours", 10, 2).alias("total_hours"),
        _dec("time_cost", 14, 2).alias("time_cost"),
        _dec("burdened_time_cost", 14, 2).alias("burdened_time_cost"),
        _dec("price", 14, 2).alias("price"),
        _dec("pass_through_revenue", 14, 2).alias("pass_through_revenue"),
        _dec("net_revenue", 14, 2).alias("net_revenue"),
        _dec("field_cost", 14, 2).alias("field_cost"),
        _dec("incentive_cost", 14, 2).alias("incentive_cost"),
        _dec("travel_cost", 14, 2).alias("travel_cost"),
        _dec("project_profit", 14, 2).alias("project_profit"),
        _dec(safe_ratio(F.col("project_profit"), F.col("net_revenue")), 9, 4).alias("project_profit_pct"),
        _dec("contribution_margin", 14, 2).alias("contribution_margin"),
        _dec(safe_ratio(F.col("contribution_margin"), F.col("net_revenue")), 9, 4).alias(
            "contribution_margin_pct"
        ),
    )


def _external_clients(dim_client: DataFrame) -> DataFrame:
    # inner join with residual predicate `and not is_internal` == filter the dimension first
    return dim_client.filter(~F.col("is_internal")).select("client_id", "client_name")


def client_hours(entries: DataFrame, dim_client: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """Hours on external clients by client, employee and day (R8). The fact is summed
    per (client, employee, day) before the dimension joins."""
    emp = dim_employee.select("employee_id", "employee_name", "department_name")
    per_key = entries.groupBy("client_id", "employee_id", "entry_date").agg(
        F.sum("hours").alias("hours"), F.sum("client_facing_hours").alias("client_facing_hours")
    )
    joined = per_key.join(_external_clients(dim_client), "client_id", "inner").join(emp, "employee_id", "left")
    return joined.select(
        F.col("client_id").cast("int").alias("client_id"),
        F.col("client_name").cast("string").alias("client_name"),
        F.col("employee_id").cast("int").alias("employee_id"),
        F.col("employee_name").cast("string").alias("employee_name"),
        F.col("department_name").cast("string").alias("department_name"),
        F.col("entry_date").cast("date").alias("entry_date"),
        _dec(F.col("hours"), 10, 2).alias("total_hours"),
        _dec(F.col("client_facing_hours"), 10, 2).alias("client_facing_hours"),
    )


def client_totals(entries: DataFrame, dim_client: DataFrame) -> DataFrame:
    """External client totals: the fact is summed per client first, then joined to
    the (filtered) client dimension - one row per client crosses the join."""
    per_client = entries.groupBy("client_id").agg(
        F.sum("client_facing_hours").alias("client_facing_hours"),
        F.sum("hours").alias("total_hours"),
    )
    return per_client.join(_external_clients(dim_client), "client_id", "inner").select(
        "client_id", "client_name", "client_facing_hours", "total_hours"
    )


def top_clients(entries: DataFrame, dim_client: DataFrame, n: int = 15) -> DataFrame:
    """External clients ranked by client-facing then total hours.

    Ties share a rank, so more than ``n`` clients can be flagged. NULL sums sort first
    under DESC, as in the warehouse.
    """
    totals = client_totals(entries, dim_client)
    ranked = global_rank(
        totals, ["client_facing_hours", "total_hours"], descending=True, nulls_first=True, name="client_rank"
    )
    return ranked.select(
        F.col("client_id").cast("int").alias("client_id"),
        F.col("client_name").cast("string").alias("client_name"),
        _dec("client_facing_hours", 10, 2).alias("client_facing_hours"),
        _dec("total_hours", 10, 2).alias("total_hours"),
        F.col("client_rank").cast("int").alias("client_rank"),
        (F.col("client_rank") <= F.lit(n)).alias("is_top_15"),
    )


def task_breakdown(
    entries: DataFrame,
    dim_employee: DataFrame,
    dim_project: DataFrame,
    dim_client: DataFrame,
    dim_item: DataFrame,
) -> DataFrame:
    """Monthly hours by employee, project, client and item (R10). Hours are summed per
    (month, employee, project, client, item) ids first; the dimension attributes join
    to that much smaller set, then the output grain is grouped (ids of different items
    can share a name, so the final group by stays)."""
    per_key = entries.groupBy(
        F.trunc(F.col("entry_date"), "MM").alias("month_start"), "employee_id", "project_id", "client_id", "item_id"
    ).agg(F.sum("hours").alias("hours"))
    # entries without a project match none: a key of their own spreads them over all tasks,
    # which a NULL would gather in one
    ids = [F.col(c) for c in ("month_start", "employee_id", "client_id", "item_id")]
    e = per_key.withColumn("__spread", F.when(F.col("project_id").isNull(), F.xxhash64(*ids))).alias("e")
    emp = dim_employee.select("employee_id", "employee_name", "department_name").alias("emp")
    prj = dim_project.select("project_id", "project_display_name", "department_name", "client_name").where(
        F.col("project_id").isNotNull()).alias("prj")
    cli = dim_client.select("client_id", "client_name").alias("cli")
    itm = dim_item.select("item_id", "item_name", "category_name").alias("itm")
    joined = (
        e.join(emp, F.col("e.employee_id") == F.col("emp.employee_id"), "left")
        .join(prj, [F.coalesce(F.col("e.project_id"), F.col("e.__spread")) == F.col("prj.project_id"),
                    F.col("e.__spread").isNull() == F.col("prj.project_id").isNotNull()], "left")
        .join(cli, F.col("e.client_id") == F.col("cli.client_id"), "left")
        .join(itm, F.col("e.item_id") == F.col("itm.item_id"), "left")
    )
    return joined.groupBy(
        F.col("e.month_start").alias("month_start"),
        F.col("e.employee_id").cast("int").alias("employee_id"),
        F.col("emp.employee_name").cast("string").alias("employee_name"),
        F.col("emp.department_name").cast("string").alias("employee_department"),
        F.col("e.project_id").cast("int").alias("project_id"),
        F.col("prj.project_display_name").cast("string").alias("project_display_name"),
        F.col("prj.department_name").cast("string").alias("project_department"),
        F.coalesce(F.col("prj.client_name"), F.col("cli.client_name")).cast("string").alias("client_name"),
        F.col("itm.item_name").cast("string").alias("item_name"),
        F.col("itm.category_name").cast("string").alias("category_name"),
    ).agg(_dec(F.sum("e.hours"), 10, 2).alias("hours"))


# --- contracted reporting views (P22) with per-person rates and costs left out (P23) ---

def _contract(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    return df.select(*[F.col(name).cast(dtype).alias(name) for name, dtype in columns])


def publish(name: str, df: DataFrame) -> DataFrame:
    """The contracted reporting view ``name``: an allow-list select with declared types,
    so per-person rates and per-entry costs never reach the reporting layer (P22/P23)."""
    return _contract(df, CONTRACTS[name])


# Columns that must never reach the reporting layer (per-person rates, per-entry costs).
REDACTED_COLUMNS = ("cost_per_hour", "burdened_cost_per_hour", "time_cost", "burdened_time_cost", "email")
