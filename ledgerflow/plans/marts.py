"""Marts: the star schema (R5) - dimensions and pass-through facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dim_date(calendar_df: DataFrame) -> DataFrame:
    d = F.col("date_day")
    return calendar_df.select(
        "date_day",
        "week_start",
        F.concat(F.lit("Week of "), F.date_format("week_start", "yyyy-MM-dd")).alias("week_label"),
        F.trunc(d, "MM").alias("month_start"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        (F.dayofweek(d) - 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        "is_weekday",
    )


def dim_employee(
    employees: DataFrame, departments: DataFrame, groups: DataFrame, calendar_df: DataFrame
) -> DataFrame:
    """Employees with department, reporting group and employment status (P20).

    The calendar end is a scalar subquery (J7: the one-row relation of the model)."""
    last_day = calendar_df.agg(F.max("date_day")).scalar()
    e = employees.alias("e")
    dep = departments.select("department_id", "department_name").alias("dep")
    grp = groups.select("department_name", "group_name").alias("grp")
    joined = (
        e.join(dep, F.col("e.department_id") == F.col("dep.department_id"), "left")
        .join(grp, F.col("dep.department_name") == F.col("grp.department_name"), "left")
    )
    return joined.select(
        F.col("e.employee_id"),
        F.col("e.employee_name"),
        F.col("e.first_name"),
        F.col("e.last_name"),
        F.col("e.email"),
        F.col("e.department_id"),
        F.col("dep.department_name"),
        F.coalesce(F.col("grp.group_name"), F.col("dep.department_name")).alias("group_name"),
        F.col("e.title"),
        F.col("e.hire_date"),
        F.col("e.release_date"),
        F.when(F.col("e.release_date") < last_day, "Released")
        .otherwise("Current")
        .alias("employment_status"),
        F.col("e.standard_hours_per_day"),
        F.col("e.cost_per_hour"),
        F.col("e.burdened_cost_per_hour"),
        F.col("e.is_inactive"),
    )


def dim_client(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("customer_id").alias("client_id"),
        F.col("customer_number").alias("client_number"),
        F.col("customer_name").alias("client_name"),
        "is_internal",
        "is_inactive",
    )


def dim_project(
    projects: DataFrame, customers: DataFrame, departments: DataFrame, employees: DataFrame
) -> DataFrame:
    p = projects.alias("p")
    c = customers.select("customer_id", "customer_name").alias("c")
    dep = departments.select("department_id", "department_name").alias("dep")
    lead = employees.select("employee_id", "employee_name").alias("lead")
    joined = (
        p.join(c, F.col("p.customer_id") == F.col("c.customer_id"), "left")
        .join(dep, F.col("p.department_id") == F.col("dep.department_id"), "left")
        .join(lead, F.col("p.project_manager_id") == F.col("lead.employee_id"), "left")
    )
    return joined.select(
        F.col("p.project_id"),
        F.col("p.project_number"),
        F.col("p.project_name"),
        # nested NULL-skipping concatenation: "<number> <client> : <project>"
        F.concat_ws(
            " ",
            F.col("p.project_number"),
            F.concat_ws(" : ", F.col("c.customer_name"), F.col("p.project_name")),
        ).alias("project_display_name"),
        F.col("p.customer_id").alias("client_id"),
        F.col("c.customer_name").alias("client_name"),
        F.col("p.project_status"),
        F.col("p.project_status_rank"),
        F.col("p.project_status_label"),
        F.col("p.is_complete"),
        F.col("p.start_date"),
        F.col("p.projected_end_date"),
        F.col("p.department_id"),
        F.col("dep.department_name"),
        F.col("p.project_manager_id"),
        F.col("lead.employee_name").alias("project_lead"),
        F.col("p.is_inactive"),
    )


def dim_item(items: DataFrame, categories: DataFrame) -> DataFrame:
    it = items.alias("it")
    cat = categories.alias("cat")
    joined = it.join(cat, F.lower(F.col("it.item_name")) == F.lower(F.col("cat.item_name")), "left")
    return joined.select(
        F.col("it.item_id"),
        F.col("it.item_name"),
        F.col("it.display_name"),
        F.col("it.item_type"),
        F.coalesce(F.col("cat.category_code"), F.lit("unmapped")).alias("category_code"),
        F.coalesce(F.col("cat.category_name"), F.lit("Unmapped")).alias("category_name"),
        F.coalesce(F.col("cat.counts_as_worked"), F.lit(False)).alias("counts_as_worked"),
        F.coalesce(F.col("cat.is_client_facing"), F.lit(False)).alias("is_client_facing"),
        F.col("it.is_inactive"),
    )


def fct_time_entries(categorized: DataFrame) -> DataFrame:
    return categorized


def fct_employee_capacity(days: DataFrame) -> DataFrame:
    return days


def fct_project_financials(lines: DataFrame) -> DataFrame:
    return lines
