"""Registered queries over the driver tables (one per operator group of the survey).

Every query reads whole tables through ``StandIns`` and runs the library's models and
operators; decimals are rendered as doubles only at the very end.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.scalars import week_start
from ledgerflow.plans import intermediate, maintained, pages, reporting
from ledgerflow.plans.standins import StandIns, for_driver
from ledgerflow.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def q_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return StandIns(spark, sf).calendar


def q_date_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return StandIns(spark, sf).dim_date


def q_categorized_entries(spark: SparkSession, sf: str) -> DataFrame:
    return for_driver(StandIns(spark, sf).categorized.drop("department_id", "memo"))


def q_employee_days(spark: SparkSession, sf: str) -> DataFrame:
    return for_driver(StandIns(spark, sf).capacity)


def q_employee_days_holidays(spark: SparkSession, sf: str) -> DataFrame:
    """R3/J5 over a calendar with holes: the 5th, 15th and 25th of a month are not in it."""
    s = StandIns(spark, sf)
    open_days = s.calendar.where(F.day("date_day") % 10 != 5)
    return for_driver(intermediate.employee_days(s.employees, open_days, s.bucketed))


def q_utilization_weekly(spark: SparkSession, sf: str) -> DataFrame:
    s = StandIns(spark, sf)
    return for_driver(reporting.utilization_weekly(s.capacity, s.bucketed, s.dim_employee))


def q_capacity_from_released(spark: SparkSession, sf: str) -> DataFrame:
    """Released employees and their employed days; a release before the window gives an
    empty day series (no rows), never a descending one."""
    s = StandIns(spark, sf)
    per = s.capacity.groupBy("employee_id").agg(
        F.count(F.lit(1)).alias("days_employed"), F.sum("expected_hours").alias("expected_hours")
    )
    released = s.employees.filter(F.col("release_date").isNotNull()).select("employee_id", "release_date")
    out = released.join(per, "employee_id", "left").select(
        "employee_id",
        "release_date",
        F.coalesce(F.col("days_employed"), F.lit(0)).cast("bigint").alias("days_employed"),
        F.coalesce(F.col("expected_hours"), F.lit(0)).cast("decimal(10,2)").alias("expected_hours"),
    )
    return for_driver(out)


def q_financial_lines(spark: SparkSession, sf: str) -> DataFrame:
    fl = StandIns(spark, sf).financial_lines
    return for_driver(
        fl.drop("transaction_date", "document_number", "transaction_type_name", "account_name")
    )


def q_project_margin(spark: SparkSession, sf: str) -> DataFrame:
    s = StandIns(spark, sf)
    return for_driver(reporting.project_margin_from(s.dim_project, s.financial_lines, s.project_time))


def q_client_hours(spark: SparkSession, sf: str) -> DataFrame:
    s = StandIns(spark, sf)
    return for_driver(reporting.client_hours(s.resolved, s.dim_client, s.dim_employee))


def _maintained(spark: SparkSession, sf: str, report) -> DataFrame:
    """A report stored after a first load and refreshed after a second one. The second load
    brings the entries from 2024-01-25 on, late ones (every 50th entry) and corrections:
    every 97th entry was logged for another person and client before."""
    s, facts = StandIns(spark, sf), scratch_path(spark, "facts")
    wanted = ("time_entry_id", "entry_date", "employee_id", "client_id", "project_id", "hours", "worked_hours",
              "client_facing_hours", *[f"{b}_hours" for b in intermediate.BUCKETS], "unmapped_hours", "time_cost", "burdened_time_cost")
    s.categorized.select(*wanted, week_start(F.col("entry_date")).alias("week_start")).write.partitionBy("week_start").parquet(facts)
    after = spark.read.parquet(facts)
    pk = F.col("time_entry_id")
    moved, late = pk % 97 == 1, (F.col("entry_date") >= F.lit("2024-01-25").cast("date")) | (pk % 50 == 0)
    before = after.where(~late | moved)
    for c in ("employee_id", "client_id", "project_id"):
        before = before.withColumn(c, F.when(moved, F.col(c) + 1).otherwise(F.col(c)))
    changed = after.where(late | moved).select("time_entry_id")
    root = scratch_path(spark, "reports")
    maintained.rebuild(spark, report(s, before), root, "first")
    second = report(s, after)
    touched = maintained.touched_keys(before, after, changed, "time_entry_id", second.keys)
    maintained.refresh(spark, second, touched, root, "second")
    return for_driver(maintained.read_report(spark, second, root))


def q_maintained_utilization(spark: SparkSession, sf: str) -> DataFrame:
    """Only the touched (employee, week) pairs are recomputed; equals the full rebuild."""
    return _maintained(spark, sf, lambda s, entries: maintained.utilization_weekly(s.capacity_on(entries), entries, s.dim_employee))


def q_maintained_client_hours(spark: SparkSession, sf: str) -> DataFrame:
    """K6/R8 by (client, day)."""
    return _maintained(spark, sf, lambda s, entries: maintained.client_hours(entries, s.dim_client, s.dim_employee))


def q_maintained_margin(spark: SparkSession, sf: str) -> DataFrame:
    """K6/R7 by project."""
    return _maintained(spark, sf, lambda s, entries: maintained.project_margin(s.dim_project, s.financial_lines_on, entries))


def q_top_clients(spark: SparkSession, sf: str) -> DataFrame:
    s = StandIns(spark, sf)
    return for_driver(reporting.top_clients(s.resolved, s.dim_client, n=15))


def q_task_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    s = StandIns(spark, sf)
    return for_driver(
        reporting.task_breakdown(s.resolved, s.dim_employee, s.dim_project, s.dim_client, s.dim_item)
    )


def _star(s: StandIns, entries: DataFrame | None = None) -> pages.Star:
    return pages.Star(
        facts={"time_entries": s.resolved if entries is None else entries, "capacity": s.capacity},
        dims={
            "date": s.dim_date,
            "employee": s.dim_employee,
            "client": s.dim_client,
            "project": s.dim_project,
            "item": s.dim_item,
        },
    )


SELECTED_ITEMS = ("view", "click", "purchase")


def q_utilization_rollup(spark: SparkSession, sf: str) -> DataFrame:
    s = StandIns(spark, sf)
    return pages.utilization_page(_star(s, s.bucketed), (datetime.date(2024, 1, 7), datetime.date(2024, 1, 27)))


def q_client_rank_in_selection(spark: SparkSession, sf: str) -> DataFrame:
    s = StandIns(spark, sf)
    return for_driver(
        pages.pivot(
            _star(s),
            [("client", "client_name"), ("employee", "department_name"), ("employee", "employee_name")],
            ["Total Hours", "Client Hours", "Client Rank"],
            {("client", "is_internal"): False},
        )
    )


def q_tasks_by_person(spark: SparkSession, sf: str) -> DataFrame:
    return for_driver(pages.tasks_by_person_page(_star(StandIns(spark, sf)), SELECTED_ITEMS))


def q_persons_by_task(spark: SparkSession, sf: str) -> DataFrame:
    return for_driver(pages.persons_by_task_page(_star(StandIns(spark, sf)), SELECTED_ITEMS))


def q_margin_measures(spark: SparkSession, sf: str) -> DataFrame:
    s = StandIns(spark, sf)
    margin = reporting.project_margin_from(s.dim_project, s.financial_lines, s.project_time)
    return for_driver(pages.margin_page(margin))


def queries() -> dict[str, Query]:
    return {
        "utilization_rollup": q_utilization_rollup,
        "client_rank_in_selection": q_client_rank_in_selection,
        "tasks_by_person": q_tasks_by_person,
        "persons_by_task": q_persons_by_task,
        "margin_measures": q_margin_measures,
        "financial_lines": q_financial_lines,
        "project_margin": q_project_margin,
        "client_hours": q_client_hours,
        "maintained_utilization": q_maintained_utilization,
        "maintained_client_hours": q_maintained_client_hours,
        "maintained_margin": q_maintained_margin,
        "top_clients": q_top_clients,
        "task_breakdown": q_task_breakdown,
        "calendar": q_calendar,
        "date_dimension": q_date_dimension,
        "categorized_entries": q_categorized_entries,
        "employee_days": q_employee_days,
        "employee_days_holidays": q_employee_days_holidays,
        "utilization_weekly": q_utilization_weekly,
        "capacity_from_released": q_capacity_from_released,
    }
