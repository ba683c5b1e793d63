"""Intermediate models (R1-R4): calendar spine, categorized time, capacity spine,
project financial lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.scalars import day_series, is_weekday, week_start
from ledgerflow.operators.ranges import interval_join

BUCKETS = ("project_work", "client_bd", "internal_productive", "internal_admin", "exempt")
REVENUE_DOCUMENTS = ("SalesOrd", "CustInvc", "CustCred")
REVENUE_ACCOUNT_TYPES = ("Income", "OthIncome", "DeferRevenue")
REVENUE_CLASSES = ("revenue", "pass_through_travel", "pass_through_incentive")
PASS_THROUGH_CLASSES = ("pass_through_travel", "pass_through_incentive")
PENDING_PO_STATUSES = ("Pending Supervisor Approval", "Pending Billing")
DAYS_OF_A_BIN = 32
COST_CLASSES = ("field_cost", "incentive_cost", "travel_cost")


def calendar_bounds(time_entries: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """One row (first_day, last_day); last_day defaults to the latest logged day."""
    last = F.lit(end).cast("date") if end else F.max("entry_date")
    return time_entries.agg(
        F.lit(start).cast("date").alias("first_day"), last.cast("date").alias("last_day")
    )


def calendar(time_entries: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """Every day of the reporting window with its Sunday week start and weekday flag.

    The bound is a one-row global aggregate (partial per partition, then one final row);
    the day series is generated from that row, so no cross join with data happens.
    """
    days = calendar_bounds(time_entries, start, end).select(
        F.explode(day_series(F.col("first_day"), F.col("last_day"))).alias("date_day")
    )
    return days.select(
        "date_day",
        week_start(F.col("date_day")).alias("week_start"),
        is_weekday(F.col("date_day")).alias("is_weekday"),
    )


def _hours_when(cond: F.Column, hours: F.Column) -> F.Column:
    return F.when(cond, hours).otherwise(F.lit(0)).cast("decimal(8,2)")


def bucket_time(entries: DataFrame, items: DataFrame, categories: DataFrame) -> DataFrame:
    """Each entry with its item's category and its hours split into buckets: all that
    capacity and utilization need, without projects, clients or rates."""
    it = items.select("item_id", "item_name").alias("it")
    cat = categories.alias("cat")
    named = it.join(cat, F.lower(F.col("cat.item_name")) == F.lower(F.col("it.item_name")), "left").select(
        F.col("it.item_id").alias("__item"), F.col("it.item_name").alias("item_name"),
        "category_code", "category_name", "counts_as_worked", "is_client_facing")
    joined = entries.join(named, entries["item_id"] == F.col("__item"), "left")
    hours, code = F.col("hours"), F.col("category_code")
    return joined.select(
        *[entries[c] for c in entries.columns],
        "item_name",
        F.coalesce(code, F.lit("unmapped")).alias("category_code"),
        F.coalesce("category_name", F.lit("Unmapped")).alias("category_name"),
        F.coalesce("counts_as_worked", F.lit(False)).alias("counts_as_worked"),
        F.coalesce("is_client_facing", F.lit(False)).alias("is_client_facing"),
        _hours_when(F.col("counts_as_worked"), hours).alias("worked_hours"),
        _hours_when(F.col("is_client_facing"), hours).alias("client_facing_hours"),
        *[_hours_when(code == b, hours).alias(f"{b}_hours") for b in BUCKETS],
        _hours_when(code.isNull(), hours).alias("unmapped_hours"),
    )


def resolve_references(bucketed: DataFrame, projects: DataFrame) -> DataFrame:
    """The entry's reference names a project, whose client it then is, or else directly a
    client (J10)."""
    p = projects.select(F.col("project_id"), F.col("customer_id").alias("__client"))
    joined = bucketed.join(p, bucketed["customer_ref_id"] == F.col("project_id"), "left")
    direct = F.when(F.col("project_id").isNull(), F.col("customer_ref_id"))
    return joined.withColumn("client_id", F.coalesce("__client", direct)).drop("__client")


def cost_time(entries: DataFrame, employees: DataFrame) -> DataFrame:
    """Hours at the employee's plain and burdened rate."""
    emp = employees.select(F.col("employee_id").alias("__emp"), "cost_per_hour", "burdened_cost_per_hour")
    joined = entries.join(emp, entries["employee_id"] == F.col("__emp"), "left")
    return joined.select(
        *[entries[c] for c in entries.columns],
        (F.col("hours") * F.col("cost_per_hour")).cast("decimal(14,4)").alias("time_cost"),
        (F.col("hours") * F.col("burdened_cost_per_hour")).cast("decimal(14,4)").alias("burdened_time_cost"),
    )


def categorize_time(
    entries: DataFrame,
    items: DataFrame,
    categories: DataFrame,
    projects: DataFrame,
    employees: DataFrame,
) -> DataFrame:
    """Each time entry categorized, its hours split into buckets, its client resolved and
    its cost (R2): the three steps above. Reports that need fewer columns read the earlier
    steps, as a left join under a sum cannot be dropped by the optimizer.

    All joins are left joins, so every entry survives; the planner broadcasts dimensions
    under its size threshold and shuffles otherwise (AQE re-plans with real sizes and
    splits skewed keys)."""
    steps = cost_time(resolve_references(bucket_time(entries, items, categories), projects), employees)
    return steps.select(
        "time_entry_id", "entry_date", "employee_id", "department_id", "item_id", "item_name",
        "category_code", "category_name", "counts_as_worked", "is_client_facing", "project_id", "client_id",
        "hours", "worked_hours", "client_facing_hours", *[f"{b}_hours" for b in BUCKETS], "unmapped_hours",
        "time_cost", "burdened_time_cost", "is_billable", "memo",
    )


def employee_days(employees: DataFrame, calendar_df: DataFrame, categorized: DataFrame) -> DataFrame:
    """The capacity spine: one row per employee per calendar day employed.

    The calendar is joined, whatever days it holds: ``day >= hire and (release is null or
    day <= release)`` is an interval join by bins of a month (J5), so there is no nested
    loop, and an employee is at most one row per month of the calendar before the join.
    Exempt hours are pre-aggregated per (employee, day) before the join (J6).
    """
    day = F.col("date_day")
    days = calendar_df.select("date_day", week_start(day).alias("week_start"), is_weekday(day).alias("is_weekday"))
    spans = employees.select("employee_id", "hire_date", "release_date", "standard_hours_per_day")
    spine = interval_join(days, spans, F.unix_date("date_day"), F.unix_date("hire_date"), F.unix_date("release_date"), DAYS_OF_A_BIN)
    exempt = categorized.groupBy("employee_id", "entry_date").agg(
        F.sum("exempt_hours").alias("exempt_hours")
    )
    joined = spine.join(
        exempt.withColumnRenamed("entry_date", "date_day"), ["employee_id", "date_day"], "left"
    )
    weekday = F.col("is_weekday")
    std = F.col("standard_hours_per_day")
    exempt_h = F.coalesce(F.col("exempt_hours"), F.lit(0))
    return joined.select(
        "employee_id",
        "date_day",
        "week_start",
        "is_weekday",
        F.when(weekday, std).otherwise(F.lit(0)).cast("decimal(8,2)").alias("standard_hours"),
        exempt_h.cast("decimal(8,2)").alias("exempt_hours"),
        F.when(weekday, F.greatest(std - exempt_h, F.lit(0)))
        .otherwise(F.lit(0))
        .cast("decimal(8,2)")
        .alias("expected_hours"),
    )


def project_financial_lines(
    lines: DataFrame,
    projects: DataFrame,
    transactions: DataFrame,
    accounting: DataFrame,
    accounts: DataFrame,
    classes: DataFrame,
) -> DataFrame:
    """Project transaction lines with margin rules made explicit.

    Lines (non-header) x projects x transactions x accounting lines (composite key)
    x accounts, left join to the bounded account-class seed. Revenue accounts are
    sign-flipped; the first matching exclusion rule names the reason.
    """
    ln = lines.filter(~F.col("is_mainline")).alias("ln")
    pr = projects.select("project_id", "is_complete").alias("pr")
    tx = transactions.alias("tx")
    ac = accounting.alias("ac")
    acct = accounts.alias("acct")
    cls = classes.select("account_number", "account_class").alias("cls")

    joined = (
        ln.join(pr, F.col("ln.entity_id") == F.col("pr.project_id"), "inner")
        .join(tx, F.col("ln.transaction_id") == F.col("tx.transaction_id"), "inner")
        .join(
            ac,
            (F.col("ln.transaction_id") == F.col("ac.transaction_id"))
            & (F.col("ln.line_id") == F.col("ac.line_id")),
            "inner",
        )
        .join(acct, F.col("ac.account_id") == F.col("acct.account_id"), "inner")
        .join(cls, F.col("acct.account_number") == F.col("cls.account_number"), "left")
    )
    ttype = F.col("tx.transaction_type")
    tstatus = F.col("tx.transaction_status")
    atype = F.col("acct.account_type")
    aclass = F.col("cls.account_class")
    amount = (
        F.when(atype.isin(*REVENUE_ACCOUNT_TYPES), -F.col("ac.amount"))
        .otherwise(F.col("ac.amount"))
        .cast("decimal(14,2)")
    )
    reason = (
        F.when(aclass == "excluded", "excluded account")
        .when(tstatus == "Rejected by Supervisor", "rejected by supervisor")
        .when(
            (ttype == "PurchOrd") & ~tstatus.isin(*PENDING_PO_STATUSES),
            "purchase order no longer pending",
        )
        .when(
            (atype == "DeferRevenue") & ~ttype.isin(*REVENUE_DOCUMENTS),
            "deferred revenue outside a sales document",
        )
        .when(ttype == "VendAuth", "vendor return authorization")
    )
    classified = joined.select(
        F.col("ln.transaction_id"),
        F.col("ln.line_id"),
        F.col("ln.entity_id").alias("project_id"),
        F.col("pr.is_complete").alias("project_is_complete"),
        F.col("tx.transaction_date"),
        F.col("tx.document_number"),
        ttype.alias("transaction_type"),
        F.col("tx.transaction_type_name"),
        tstatus.alias("transaction_status"),
        F.col("acct.account_id"),
        F.col("acct.account_number"),
        F.col("acct.account_name"),
        atype.alias("account_type"),
        aclass.alias("account_class"),
        amount.alias("amount"),
        ttype.isin(*REVENUE_DOCUMENTS).alias("is_revenue_document"),
        F.coalesce(aclass.isin(*REVENUE_CLASSES) | (atype == "DeferRevenue"), F.lit(False)).alias(
            "is_revenue_account"
        ),
        reason.alias("exclusion_reason"),
    )
    priced = classified.withColumn(
        "is_excluded", F.col("exclusion_reason").isNotNull()
    ).withColumn(
        "counts_toward_price",
        F.when(
            F.col("project_is_complete"), F.col("transaction_type").isin("CustInvc", "CustCred")
        ).otherwise(F.col("transaction_type") == "SalesOrd"),
    )
    kept = ~F.col("is_excluded")
    amt = F.col("amount")

    def money(cond: F.Column) -> F.Column:
        return F.when(cond, amt).otherwise(F.lit(0)).cast("decimal(14,2)")

    return priced.select(
        "*",
        money(
            kept
            & F.col("is_revenue_document")
            & F.col("is_revenue_account")
            & F.col("counts_toward_price")
        ).alias("price_amount"),
        money(
            kept
            & F.col("is_revenue_document")
            & F.col("counts_toward_price")
            & F.col("account_class").isin(*PASS_THROUGH_CLASSES)
        ).alias("pass_through_amount"),
        *[money(kept & (F.col("account_class") == c)).alias(c) for c in COST_CLASSES],
    )
