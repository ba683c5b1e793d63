"""What is promised about the models: the published columns and the declared tests."""

from __future__ import annotations

from ledgerflow.operators.quality import Check
from ledgerflow.sources.seeds import ACCOUNT_CLASS_CODES, CATEGORY_CODES


def _columns(text: str) -> list[tuple[str, str]]:
    """``name type`` pairs, one per line or separated by semicolons."""
    return [tuple(part.split()) for line in text.strip().splitlines() for part in line.split(";") if part.strip()]


# fixed values: names, order and types of the published columns
CONTRACTS: dict[str, list[tuple[str, str]]] = {
    "dim_date": _columns("""
        date_day date; week_start date; week_label string; month_start date; month_name string
        quarter int; year int; day_of_week int; day_name string; is_weekday boolean"""),
    "dim_employee": _columns("""
        employee_id int; employee_name string; department_name string; group_name string; title string
        hire_date date; release_date date; employment_status string; standard_hours_per_day decimal(4,2)"""),
    "dim_client": _columns("client_id int; client_number string; client_name string; is_internal boolean; is_inactive boolean"),
    "dim_project": _columns("""
        project_id int; project_number string; project_name string; project_display_name string; client_id int
        client_name string; project_status string; project_status_label string; is_complete boolean
        start_date date; projected_end_date date; department_name string; project_lead string"""),
    "dim_item": _columns("""
        item_id int; item_name string; category_code string; category_name string
        counts_as_worked boolean; is_client_facing boolean"""),
    "fct_time_entries": _columns("""
        time_entry_id int; entry_date date; employee_id int; item_id int; project_id int; client_id int
        hours decimal(8,2); worked_hours decimal(8,2); client_facing_hours decimal(8,2); project_work_hours decimal(8,2)
        client_bd_hours decimal(8,2); internal_productive_hours decimal(8,2); internal_admin_hours decimal(8,2)
        exempt_hours decimal(8,2); unmapped_hours decimal(8,2); is_billable boolean"""),
    "fct_employee_capacity": _columns("""
        employee_id int; date_day date; standard_hours decimal(8,2); exempt_hours decimal(8,2); expected_hours decimal(8,2)"""),
    "rpt_utilization_weekly": _columns("""
        employee_id int; employee_name string; department_name string; group_name string; week_start date
        standard_hours decimal(10,2); expected_hours decimal(10,2); worked_hours decimal(10,2); project_work_hours decimal(10,2)
        client_bd_hours decimal(10,2); internal_productive_hours decimal(10,2); internal_admin_hours decimal(10,2)
        exempt_hours decimal(10,2); net_utilization_pct decimal(9,4); project_work_pct decimal(9,4); client_bd_pct decimal(9,4)
        internal_pct decimal(9,4); exempt_pct decimal(9,4)"""),
    "rpt_client_hours": _columns("""
        client_id int; client_name string; employee_id int; employee_name string; department_name string
        entry_date date; total_hours decimal(10,2); client_facing_hours decimal(10,2)"""),
    "rpt_top_clients": _columns("""
        client_id int; client_name string; client_facing_hours decimal(10,2); total_hours decimal(10,2)
        client_rank int; is_top_15 boolean"""),
    "rpt_task_breakdown": _columns("""
        month_start date; employee_id int; employee_name string; employee_department string; project_id int
        project_display_name string; project_department string; client_name string; item_name string
        category_name string; hours decimal(10,2)"""),
    "rpt_project_margin": _columns("""
        project_id int; project_display_name string; client_name string; department_name string; project_lead string
        project_status_label string; start_date date; total_hours decimal(10,2); time_cost decimal(14,2)
        burdened_time_cost decimal(14,2); price decimal(14,2); pass_through_revenue decimal(14,2); net_revenue decimal(14,2)
        field_cost decimal(14,2); incentive_cost decimal(14,2); travel_cost decimal(14,2); project_profit decimal(14,2)
        project_profit_pct decimal(9,4); contribution_margin decimal(14,2); contribution_margin_pct decimal(9,4)"""),
}

# fixed values: the key of each dimension and fact; one column must be unique and not null,
# several must be unique together
KEYS = {
    "dim_date": ("date_day",), "dim_employee": ("employee_id",), "dim_client": ("client_id",), "dim_project": ("project_id",),
    "dim_item": ("item_id",), "fct_time_entries": ("time_entry_id",), "fct_employee_capacity": ("employee_id", "date_day"),
    "fct_project_financials": ("transaction_id", "line_id"),
}


def model_checks() -> list[Check]:
    """The tests declared for the marts, as one list for ``quality.run_checks``."""
    out = []
    for model, key in KEYS.items():
        if len(key) == 1:
            out += [Check(f"unique_{model}_{key[0]}", model, "unique", key), Check(f"not_null_{model}_{key[0]}", model, "not_null", key)]
        else:
            out.append(Check(f"unique_{model}", model, "unique_combination", key))
    return out


# fixed values: the tests declared for staging, seeds, intermediate models and reports
ROW_KEYS = {
    "stg_accounts": "account_id", "stg_customers": "customer_id", "stg_departments": "department_id", "stg_employees": "employee_id",
    "stg_items": "item_id", "stg_projects": "project_id", "stg_time_entries": "time_entry_id", "stg_transactions": "transaction_id",
    "int_calendar": "date_day", "int_time_entries__categorized": "time_entry_id",
    "time_categories": "item_name", "account_classes": "account_number", "department_groups": "department_name",
    "rpt_project_margin": "project_id",
}
COMBINATIONS = {
    "stg_transaction_lines": ("transaction_id", "line_id"), "stg_transaction_accounting_lines": ("transaction_id", "line_id"),
    "int_employee_days": ("employee_id", "date_day"), "rpt_utilization_weekly": ("employee_id", "week_start"),
}
REQUIRED = (("stg_employees", "standard_hours_per_day"), ("stg_time_entries", "hours"))
ACCEPTED = (
    ("dim_employee", "employment_status", ("Current", "Released")),
    ("stg_projects", "project_status_rank", (1, 2, 3, 4, 5)),
    ("int_time_entries__categorized", "category_code", (*CATEGORY_CODES, "unmapped")),
    ("time_categories", "category_code", CATEGORY_CODES),
    ("account_classes", "account_class", ACCOUNT_CLASS_CODES),
)
REFERENCES = (
    ("fct_time_entries", "entry_date", "dim_date", "date_day", "error"),
    ("fct_time_entries", "employee_id", "dim_employee", "employee_id", "warn"),
)


def project_checks() -> list[Check]:
    """Every test that the project declares, over all layers, as one list for
    ``quality.run_checks``."""
    out = model_checks()
    for model, key in ROW_KEYS.items():
        out += [Check(f"unique_{model}_{key}", model, "unique", (key,)), Check(f"not_null_{model}_{key}", model, "not_null", (key,))]
    out.append(Check("unique_rpt_top_clients_client_id", "rpt_top_clients", "unique", ("client_id",)))
    out += [Check(f"unique_{model}", model, "unique_combination", columns) for model, columns in COMBINATIONS.items()]
    out += [Check(f"not_null_{model}_{column}", model, "not_null", (column,)) for model, column in REQUIRED]
    out += [Check(f"accepted_{model}_{column}", model, "accepted_values", (column,), {"values": list(values)}) for model, column, values in ACCEPTED]
    out += [Check(f"relationship_{model}_{column}", model, "relationships", (column,), {"to": to, "field": field}, severity)
            for model, column, to, field, severity in REFERENCES]
    return out
