"""The whole model DAG as lazy DataFrames (staging -> intermediate -> marts -> reporting)
and its publication as views (K6).

``build`` returns every model; nothing runs until a result is written or collected, so
Catalyst sees one plan per output and prunes columns / pushes filters through all four
layers. ``publish`` registers the views (and optionally writes the reporting tables,
which is how a scheduled run materializes them once for many readers).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.operators.runs import RUNS_SCHEMA
from ledgerflow.plans import contracts, intermediate, marts, reporting, staging
from ledgerflow.sources import seeds
from ledgerflow.session import materialize
from ledgerflow.spec import ModelParams

RAW_TABLES = ("accounts", "customers", "departments", "employees", "items", "projects", "time_entries",
              "transactions", "transaction_lines", "transaction_accounting_lines")


def build(spark: SparkSession, raw: dict[str, DataFrame], runs: DataFrame | None = None,
          params: ModelParams = ModelParams(), materialize_facts: bool = False) -> dict[str, DataFrame]:
    """All models as lazy DataFrames. With ``materialize_facts`` the categorized time
    entries (read by the capacity spine, five reports and the pages) are written once to
    the shared checkpoint folder and every consumer reads that table."""
    runs = runs if runs is not None else spark.createDataFrame([], RUNS_SCHEMA)
    m: dict[str, DataFrame] = {}
    m["stg_accounts"] = staging.stg_accounts(raw["accounts"], runs)
    m["stg_customers"] = staging.stg_customers(raw["customers"], params.internal_client_names)
    m["stg_departments"] = staging.stg_departments(raw["departments"], runs)
    m["stg_employees"] = staging.stg_employees(raw["employees"])
    m["stg_items"] = staging.stg_items(raw["items"], runs)
    m["stg_projects"] = staging.stg_projects(raw["projects"])
    m["stg_time_entries"] = staging.stg_time_entries(raw["time_entries"])
    m["stg_transactions"] = staging.stg_transactions(raw["transactions"])
    m["stg_transaction_lines"] = staging.stg_transaction_lines(raw["transaction_lines"], runs)
    m["stg_transaction_accounting_lines"] = staging.stg_transaction_accounting_lines(
        raw["transaction_accounting_lines"], runs
    )
    cats = seeds.bounded(seeds.time_categories(spark))
    classes = seeds.bounded(seeds.account_classes(spark))
    groups = seeds.bounded(seeds.department_groups(spark))
    m["int_calendar"] = intermediate.calendar(m["stg_time_entries"], params.calendar_start, params.calendar_end)
    m["int_time_entries__bucketed"] = intermediate.bucket_time(m["stg_time_entries"], m["stg_items"], cats)
    m["int_time_entries__categorized"] = intermediate.categorize_time(
        m["stg_time_entries"], m["stg_items"], cats, m["stg_projects"], m["stg_employees"]
    )
    if materialize_facts:
        m["int_time_entries__categorized"] = materialize(m["int_time_entries__categorized"], "fct_time_entries")
        m["int_time_entries__bucketed"] = m["int_time_entries__categorized"]
        entries = m["int_time_entries__categorized"]  # reports read the written table
        spent = reporting.project_time(entries)
    else:  # reports read no step that they need no column of
        entries = intermediate.resolve_references(m["int_time_entries__bucketed"], m["stg_projects"])
        spent = reporting.project_time_by_rate(m["stg_time_entries"], m["stg_projects"], m["stg_employees"])
    m["int_employee_days"] = intermediate.employee_days(
        m["stg_employees"], m["int_calendar"], m["int_time_entries__bucketed"]
    )
    m["int_project_financial_lines"] = intermediate.project_financial_lines(
        m["stg_transaction_lines"], m["stg_projects"], m["stg_transactions"],
        m["stg_transaction_accounting_lines"], m["stg_accounts"], classes,
    )
    m["dim_date"] = marts.dim_date(m["int_calendar"])
    m["dim_employee"] = marts.dim_employee(m["stg_employees"], m["stg_departments"], groups, m["int_calendar"])
    m["dim_client"] = marts.dim_client(m["stg_customers"])
    m["dim_project"] = marts.dim_project(m["stg_projects"], m["stg_customers"], m["stg_departments"], m["stg_employees"])
    m["dim_item"] = marts.dim_item(m["stg_items"], cats)
    m["fct_time_entries"] = marts.fct_time_entries(m["int_time_entries__categorized"])
    m["fct_employee_capacity"] = marts.fct_employee_capacity(m["int_employee_days"])
    m["fct_project_financials"] = marts.fct_project_financials(m["int_project_financial_lines"])
    m["rpt_utilization_weekly"] = reporting.utilization_weekly(
        m["fct_employee_capacity"], m["int_time_entries__bucketed"], m["dim_employee"]
    )
    m["rpt_project_margin"] = reporting.project_margin_from(m["dim_project"], m["fct_project_financials"], spent)
    m["rpt_client_hours"] = reporting.client_hours(entries, m["dim_client"], m["dim_employee"])
    m["rpt_top_clients"] = reporting.top_clients(entries, m["dim_client"], params.top_clients)
    m["rpt_task_breakdown"] = reporting.task_breakdown(
        entries, m["dim_employee"], m["dim_project"], m["dim_client"], m["dim_item"]
    )
    for name in contracts.CONTRACTS:
        if name.startswith("rpt_"):
            m[name] = reporting.publish(name, m[name])
        else:
            m[f"reporting_{name}"] = reporting.publish(name, m[name])
    return m


def publish(models: dict[str, DataFrame], write_to: str | None = None, names: tuple[str, ...] = ()) -> None:
    """K6: every model as a temp view; with ``write_to``, the named models (default: the
    reporting layer) are also written as Parquet tables there."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)
    if write_to:
        chosen = names or tuple(n for n in models if n.startswith(("rpt_", "reporting_")))
        for name in chosen:
            models[name].write.mode("overwrite").parquet(f"{write_to.rstrip('/')}/{name}")
