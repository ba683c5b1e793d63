"""Staging models: typed, renamed views over raw extracts.

Raw tables hold text ids, numbers and 'T'/'F' flags; every cast is ANSI (bad input
raises, as the warehouse does). Full-refresh tables are narrowed to the rows of their
job's latest successful run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.scalars import flag, regex_substring
from ledgerflow.operators.runs import latest_snapshot

# Transaction type code -> display name; unknown codes pass through.
TRANSACTION_TYPE_NAMES = [
    ("SalesOrd", "Sales Order"),
    ("CustInvc", "Invoice"),
    ("CustCred", "Credit Memo"),
    ("PurchOrd", "Purchase Order"),
    ("VendBill", "Bill"),
    ("ExpRept", "Expense Report"),
    ("VendAuth", "Vendor Return Authorization"),
    ("Journal", "Journal"),
    ("Opprtnty", "Opportunity"),
]

_STATUS_RANK = r"^(\d+)\."
_STATUS_PREFIX = r"^\d+\.\s*"


def _int(name: str) -> F.Column:
    return F.col(name).cast("int")


def ensure_columns(raw: DataFrame, names: list[str]) -> DataFrame:
    """Add raw columns the source never returned as NULL text: the API omits null
    fields, so a field that was NULL in every record never became a column."""
    for n in names:
        if n not in raw.columns:
            raw = raw.withColumn(n, F.lit(None).cast("string"))
    return raw


def stg_accounts(raw: DataFrame, runs: DataFrame) -> DataFrame:
    raw = ensure_columns(raw, ['id', 'acctnumber', 'fullname', 'accttype', 'isinactive'])
    return latest_snapshot(raw, runs, "accounts").select(
        _int("id").alias("account_id"),
        F.col("acctnumber").alias("account_number"),
        F.col("fullname").alias("account_name"),
        F.col("accttype").alias("account_type"),
        flag("isinactive").alias("is_inactive"),
    )


def stg_customers(raw: DataFrame, internal_names: Sequence[str] = ()) -> DataFrame:
    raw = ensure_columns(raw, ['id', 'entityid', 'companyname', 'email', 'phone', 'isinactive', 'datecreated', 'lastmodifieddate'])
    internal = (
        F.col("companyname").isin(*internal_names)
        if internal_names
        else F.when(F.col("companyname").isNull(), F.lit(None)).otherwise(F.lit(False))
    )
    return raw.select(
        _int("id").alias("customer_id"),
        F.col("entityid").alias("customer_number"),
        F.col("companyname").alias("customer_name"),
        F.col("email"),
        F.col("phone"),
        flag("isinactive").alias("is_inactive"),
        internal.alias("is_internal"),
        F.col("datecreated").alias("created_at"),
        F.col("lastmodifieddate").alias("last_modified_at"),
    )


def stg_departments(raw: DataFrame, runs: DataFrame) -> DataFrame:
    raw = ensure_columns(raw, ['id', 'name', 'isinactive'])
    return latest_snapshot(raw, runs, "departments").select(
        _int("id").alias("department_id"),
        F.col("name").alias("department_name"),
        flag("isinactive").alias("is_inactive"),
    )


def stg_employees(raw: DataFrame) -> DataFrame:
    raw = ensure_columns(raw, ['id', 'entityid', 'firstname', 'lastname', 'email', 'department', 'title', 'isinactive', 'hiredate', 'releasedate', 'laborcost', 'custentity_burdened_cost', 'custentity_hours_per_day', 'lastmodifieddate'])
    return raw.select(
        _int("id").alias("employee_id"),
        F.col("entityid").alias("employee_name"),
        F.col("firstname").alias("first_name"),
        F.col("lastname").alias("last_name"),
        F.col("email"),
        _int("department").alias("department_id"),
        F.col("title"),
        flag("isinactive").alias("is_inactive"),
        F.col("hiredate").cast("date").alias("hire_date"),
        F.col("releasedate").cast("date").alias("release_date"),
        F.col("laborcost").cast("decimal(10,2)").alias("cost_per_hour"),
        F.col("custentity_burdened_cost").cast("decimal(10,2)").alias("burdened_cost_per_hour"),
        F.coalesce(
            F.col("custentity_hours_per_day").cast("decimal(4,2)"), F.lit(8).cast("decimal(4,2)")
        ).alias("standard_hours_per_day"),
        F.col("lastmodifieddate").alias("last_modified_at"),
    )


def stg_items(raw: DataFrame, runs: DataFrame) -> DataFrame:
    raw = ensure_columns(raw, ['id', 'itemid', 'displayname', 'itemtype', 'isinactive'])
    return latest_snapshot(raw, runs, "items").select(
        _int("id").alias("item_id"),
        F.col("itemid").alias("item_name"),
        F.col("displayname").alias("display_name"),
        F.col("itemtype").alias("item_type"),
        flag("isinactive").alias("is_inactive"),
    )


def project_status_columns(status: F.Column) -> list[F.Column]:
    """'4. Finalized' -> rank 4, label 'Finalized', complete (rank >= 4; NULL -> false)."""
    rank = regex_substring(status, _STATUS_RANK).cast("int")
    return [
        rank.alias("project_status_rank"),
        F.regexp_replace(status, _STATUS_PREFIX, "").alias("project_status_label"),
        F.coalesce(rank >= 4, F.lit(False)).alias("is_complete"),
    ]


def stg_projects(raw: DataFrame) -> DataFrame:
    raw = ensure_columns(raw, ['id', 'entityid', 'companyname', 'parent', 'custentity_project_status', 'startdate', 'projectedenddate', 'department', 'projectmanager', 'isinactive', 'lastmodifieddate'])
    status = F.col("custentity_project_status")
    return raw.select(
        _int("id").alias("project_id"),
        F.col("entityid").alias("project_number"),
        F.col("companyname").alias("project_name"),
        _int("parent").alias("customer_id"),
        status.alias("project_status"),
        *project_status_columns(status),
        F.col("startdate").cast("date").alias("start_date"),
        F.col("projectedenddate").cast("date").alias("projected_end_date"),
        _int("department").alias("department_id"),
        _int("projectmanager").alias("project_manager_id"),
        flag("isinactive").alias("is_inactive"),
        F.col("lastmodifieddate").alias("last_modified_at"),
    )


def stg_time_entries(raw: DataFrame) -> DataFrame:
    raw = ensure_columns(raw, ['id', 'employee', 'trandate', 'hours', 'customer', 'item', 'department', 'memo', 'isbillable', 'lastmodifieddate'])
    return raw.select(
        _int("id").alias("time_entry_id"),
        _int("employee").alias("employee_id"),
        F.col("trandate").cast("date").alias("entry_date"),
        F.col("hours").cast("decimal(8,2)").alias("hours"),
        _int("customer").alias("customer_ref_id"),
        _int("item").alias("item_id"),
        _int("department").alias("department_id"),
        F.col("memo"),
        flag("isbillable").alias("is_billable"),
        F.col("lastmodifieddate").alias("last_modified_at"),
    )


def stg_transaction_accounting_lines(raw: DataFrame, runs: DataFrame) -> DataFrame:
    raw = ensure_columns(raw, ['transaction', 'transactionline', 'account', 'amount', 'posting'])
    return latest_snapshot(raw, runs, "transaction_accounting_lines").select(
        _int("transaction").alias("transaction_id"),
        _int("transactionline").alias("line_id"),
        _int("account").alias("account_id"),
        F.col("amount").cast("decimal(14,2)").alias("amount"),
        flag("posting").alias("is_posting"),
    )


def stg_transaction_lines(raw: DataFrame, runs: DataFrame) -> DataFrame:
    raw = ensure_columns(raw, ['transaction', 'id', 'linesequencenumber', 'mainline', 'entity', 'item', 'memo', 'foreignamount'])
    return latest_snapshot(raw, runs, "transaction_lines").select(
        _int("transaction").alias("transaction_id"),
        _int("id").alias("line_id"),
        _int("linesequencenumber").alias("line_sequence"),
        flag("mainline").alias("is_mainline"),
        _int("entity").alias("entity_id"),
        _int("item").alias("item_id"),
        F.col("memo"),
        F.col("foreignamount").cast("decimal(14,2)").alias("amount"),
    )


def transaction_type_name(code: F.Column) -> F.Column:
    """Simple CASE over the fixed type codes; other codes pass through."""
    expr = None
    for key, name in TRANSACTION_TYPE_NAMES:
        expr = (F.when(code == key, name) if expr is None else expr.when(code == key, name))
    return expr.otherwise(code)


def stg_transactions(raw: DataFrame) -> DataFrame:
    raw = ensure_columns(raw, ['id', 'tranid', 'type', 'status', 'entity', 'currency', 'foreigntotal', 'memo', 'trandate', 'lastmodifieddate'])
    return raw.select(
        _int("id").alias("transaction_id"),
        F.col("tranid").alias("document_number"),
        F.col("type").alias("transaction_type"),
        transaction_type_name(F.col("type")).alias("transaction_type_name"),
        F.col("status").alias("transaction_status"),
        _int("entity").alias("entity_id"),
        _int("currency").alias("currency_id"),
        F.col("foreigntotal").cast("decimal(14,2)").alias("total_amount"),
        F.col("memo"),
        F.col("trandate").cast("date").alias("transaction_date"),
        F.col("lastmodifieddate").alias("last_modified_at"),
    )
