"""Model inputs derived from the driver tables.

The driver's parquet tables are not ERP extracts, so each staging-shaped input is
derived from them by a fixed rule (every rule is mirrored in the DuckDB oracle):

  time entries   <- events     (event_id, user_id = employee, ts::date, value = hours,
                                props.k = reference: even names project k, odd names
                                client k; event_type = item)
  employees      <- customer   (custkey; department = nation; hire / release dates and
                                part-time rule from nation key and market segment)
  clients        <- customer   (segment MACHINERY = internal)
  departments    <- nation,    reporting groups <- nation x region
  projects       <- orders (ids above the client ids; status from order priority)
  transactions   <- orders     (type from priority, status from order status)
  lines          <- lineitem   (one line per (order, line number); line 1 is the header)
  accounting     <- lineitem   (account = part, amount = extended price)
  accounts       <- part       (number and type from part type)

Every frame reads the whole table; filters are plain predicates that reach the scan.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.plans import intermediate, maintained, marts, reporting, staging
from ledgerflow.session import materialize
from ledgerflow.sources import seeds

CALENDAR_START = "2024-01-01"
PROJECT_IDS = 1 << 30  # projects and clients share one id space: project ids start here
INTERNAL_SEGMENT = "MACHINERY"
PART_TIME_SEGMENT = "HOUSEHOLD"
RELEASED_SEGMENT = "AUTOMOBILE"
HIRE_BASE = "2023-12-20"
RELEASE_BASE = "2023-12-25"

# Event type -> item id (items are named by the event type).
EVENT_ITEMS = [(1, "signup"), (2, "view"), (3, "error"), (4, "click"), (5, "purchase")]

# Category map for the event items; names in mixed case (matched
# case-insensitively); 'error' is left unmapped; 'refund' maps but never occurs.
EVENT_CATEGORIES = [
    ("View", "project_work", "Project Work", True, True),
    ("CLICK", "client_bd", "Client - BD", True, True),
    ("Signup", "internal_productive", "Internal - Productive", True, False),
    ("Refund", "internal_admin", "Internal - Admin", True, False),
    ("Purchase", "exempt", "Exempt", False, False),
]

# Order priority code -> transaction type.
PRIORITY_TYPES = [
    ("1-URGENT", "SalesOrd"),
    ("2-HIGH", "CustInvc"),
    ("3-MEDIUM", "CustCred"),
    ("4-NOT SPECIFIED", "PurchOrd"),
    ("5-LOW", "VendAuth"),
]

# Order status -> transaction status.
ORDER_STATUSES = [("F", "Billed"), ("O", "Pending Billing"), ("P", "Rejected by Supervisor")]

# Part type -> (account number, account type).
PART_ACCOUNTS = [
    ("STANDARD", "40000", "Income"),
    ("PROMO", "40110", "Income"),
    ("ECONOMY", "25000", "DeferRevenue"),
    ("LARGE", "50100", "COGS"),
    ("SMALL", "50300", "COGS"),
    ("MEDIUM", "32000", "Equity"),
]


def _case(col: F.Column, pairs: list[tuple], default=None) -> F.Column:
    expr = None
    for key, value in pairs:
        expr = F.when(col == key, value) if expr is None else expr.when(col == key, value)
    return expr.otherwise(default) if default is not None else expr


@dataclass
class StandIns:
    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # --- staging-shaped inputs -------------------------------------------------------

    @cached_property
    def time_entries(self) -> DataFrame:
        ev = self.table("events")
        reference = F.get_json_object("props", "$.k").cast("int")
        return ev.select(
            F.col("event_id").cast("int").alias("time_entry_id"),
            F.col("user_id").cast("int").alias("employee_id"),
            F.col("ts").cast("date").alias("entry_date"),
            F.round(F.col("value"), 2).cast("decimal(8,2)").alias("hours"),
            F.when(reference % 2 == 0, reference + PROJECT_IDS).otherwise(reference).alias("customer_ref_id"),
            _case(F.col("event_type"), [(n, i) for i, n in EVENT_ITEMS]).cast("int").alias("item_id"),
            F.lit(None).cast("int").alias("department_id"),
            F.lit(None).cast("string").alias("memo"),
            F.col("event_type").isin("view", "click").alias("is_billable"),
        )

    @cached_property
    def items(self) -> DataFrame:
        rows = [(i, n, n.title(), "Service", False) for i, n in EVENT_ITEMS]
        # a literal of five rows: bounded by construction, so it is broadcast
        return seeds.bounded(seeds.literal(
            self.spark, rows, "item_id int, item_name string, display_name string, item_type string, is_inactive boolean"
        ))

    @cached_property
    def categories(self) -> DataFrame:
        return seeds.bounded(seeds.literal(self.spark, EVENT_CATEGORIES, seeds.TIME_CATEGORIES_SCHEMA))

    @cached_property
    def employees(self) -> DataFrame:
        c = self.table("customer")
        nk = F.col("c_nationkey")
        seg = F.col("c_mktsegment")
        cost = (F.lit(40) + nk).cast("decimal(10,2)")
        return c.select(
            F.col("c_custkey").cast("int").alias("employee_id"),
            F.col("c_name").alias("employee_name"),
            F.lit(None).cast("string").alias("first_name"),
            F.lit(None).cast("string").alias("last_name"),
            F.lit(None).cast("string").alias("email"),
            nk.cast("int").alias("department_id"),
            seg.alias("title"),
            F.lit(False).alias("is_inactive"),
            F.date_add(F.lit(HIRE_BASE).cast("date"), nk).alias("hire_date"),
            F.when(seg == RELEASED_SEGMENT, F.date_add(F.lit(RELEASE_BASE).cast("date"), nk)).alias(
                "release_date"
            ),
            cost.alias("cost_per_hour"),
            (cost * F.lit(1.5).cast("decimal(2,1)")).cast("decimal(10,2)").alias("burdened_cost_per_hour"),
            F.when(seg == PART_TIME_SEGMENT, F.lit(6)).otherwise(F.lit(8)).cast("decimal(4,2)").alias(
                "standard_hours_per_day"
            ),
        )

    @cached_property
    def customers(self) -> DataFrame:
        c = self.table("customer")
        return c.select(
            F.col("c_custkey").cast("int").alias("customer_id"),
            F.col("c_custkey").cast("string").alias("customer_number"),
            F.col("c_name").alias("customer_name"),
            (F.col("c_mktsegment") == INTERNAL_SEGMENT).alias("is_internal"),
            F.lit(False).alias("is_inactive"),
        )

    @cached_property
    def departments(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").cast("int").alias("department_id"),
            F.col("n_name").alias("department_name"),
            F.lit(False).alias("is_inactive"),
        )

    @cached_property
    def groups(self) -> DataFrame:
        n = self.table("nation")
        r = self.table("region")
        return n.join(r, n.n_regionkey == r.r_regionkey, "inner").select(
            F.col("n_name").alias("department_name"), F.col("r_name").alias("group_name")
        )

    @cached_property
    def projects(self) -> DataFrame:
        o = self.table("orders")
        pr = F.col("o_orderpriority")
        status = F.concat(F.substring(pr, 1, 1), F.lit(". "), F.substring(pr, 3, 100))
        return o.select(
            (F.col("o_orderkey") + PROJECT_IDS).cast("int").alias("project_id"),
            F.concat(F.lit("PRJ-"), F.col("o_orderkey").cast("string")).alias("project_number"),
            F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("project_name"),
            F.col("o_custkey").cast("int").alias("customer_id"),
            status.alias("project_status"),
            *staging.project_status_columns(status),
            F.col("o_orderdate").cast("date").alias("start_date"),
            F.lit(None).cast("date").alias("projected_end_date"),
            F.lit(None).cast("int").alias("department_id"),
            F.col("o_custkey").cast("int").alias("project_manager_id"),
            F.lit(False).alias("is_inactive"),
        )

    @cached_property
    def transactions(self) -> DataFrame:
        o = self.table("orders")
        ttype = _case(F.col("o_orderpriority"), PRIORITY_TYPES)
        return o.select(
            F.col("o_orderkey").cast("int").alias("transaction_id"),
            F.concat(F.lit("TX-"), F.col("o_orderkey").cast("string")).alias("document_number"),
            ttype.alias("transaction_type"),
            staging.transaction_type_name(ttype).alias("transaction_type_name"),
            _case(F.col("o_orderstatus"), ORDER_STATUSES).alias("transaction_status"),
            F.col("o_custkey").cast("int").alias("entity_id"),
            F.col("o_totalprice").cast("decimal(14,2)").alias("total_amount"),
            F.col("o_orderdate").cast("date").alias("transaction_date"),
        )

    @cached_property
    def lines(self) -> DataFrame:
        li = self.table("lineitem")
        keys = li.select(
            F.col("l_orderkey").cast("int").alias("transaction_id"),
            F.col("l_linenumber").cast("int").alias("line_id"),
        ).distinct()
        return keys.select(
            "transaction_id",
            "line_id",
            (F.col("line_id") == 1).alias("is_mainline"),
            (F.col("transaction_id") + PROJECT_IDS).alias("entity_id"),
        )

    @cached_property
    def accounting(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(
            F.col("l_orderkey").cast("int").alias("transaction_id"),
            F.col("l_linenumber").cast("int").alias("line_id"),
            F.col("l_partkey").cast("int").alias("account_id"),
            F.col("l_extendedprice").cast("decimal(14,2)").alias("amount"),
        )

    @cached_property
    def accounts(self) -> DataFrame:
        p = self.table("part")
        ptype = F.col("p_type")
        return p.select(
            F.col("p_partkey").cast("int").alias("account_id"),
            _case(ptype, [(t, n) for t, n, _ in PART_ACCOUNTS]).alias("account_number"),
            F.col("p_name").alias("account_name"),
            _case(ptype, [(t, a) for t, _, a in PART_ACCOUNTS]).alias("account_type"),
        )

    @cached_property
    def classes(self) -> DataFrame:
        return seeds.bounded(seeds.account_classes(self.spark))

    # --- model chain ----------------------------------------------------------------

    @cached_property
    def calendar(self) -> DataFrame:
        return intermediate.calendar(self.time_entries, CALENDAR_START)

    @cached_property
    def bucketed(self) -> DataFrame:
        return intermediate.bucket_time(self.time_entries, self.items, self.categories)

    @cached_property
    def resolved(self) -> DataFrame:
        return intermediate.resolve_references(self.bucketed, self.projects)

    @cached_property
    def categorized(self) -> DataFrame:
        return intermediate.categorize_time(
            self.time_entries, self.items, self.categories, self.projects, self.employees
        )

    @cached_property
    def project_time(self) -> DataFrame:
        return reporting.project_time_by_rate(self.time_entries, self.projects, self.employees)

    @cached_property
    def capacity(self) -> DataFrame:
        return intermediate.employee_days(self.employees, self.calendar, self.bucketed)

    def capacity_on(self, entries: DataFrame) -> DataFrame:
        """The capacity spine with the exempt hours of the given entries."""
        return intermediate.employee_days(self.employees, self.calendar, entries)

    @cached_property
    def financial_lines(self) -> DataFrame:
        return intermediate.project_financial_lines(
            self.lines, self.projects, self.transactions, self.accounting, self.accounts, self.classes
        )

    def financial_lines_on(self, touched: DataFrame | None) -> DataFrame:
        """The financial lines of the touched projects. Their transaction lines are stored
        first, so of the transactions and accounting lines only theirs are shuffled."""
        if touched is None:
            return self.financial_lines
        lines = materialize(maintained.only(self.lines, touched, {"entity_id": "project_id"}), "touched-lines")
        theirs = [maintained.only(df, lines, {"transaction_id": "transaction_id"}) for df in (self.transactions, self.accounting)]
        return intermediate.project_financial_lines(lines, self.projects, *theirs, self.accounts, self.classes)

    @cached_property
    def dim_date(self) -> DataFrame:
        return marts.dim_date(self.calendar)

    @cached_property
    def dim_employee(self) -> DataFrame:
        return marts.dim_employee(self.employees, self.departments, self.groups, self.calendar)

    @cached_property
    def dim_client(self) -> DataFrame:
        return marts.dim_client(self.customers)

    @cached_property
    def dim_project(self) -> DataFrame:
        return marts.dim_project(self.projects, self.customers, self.departments, self.employees)

    @cached_property
    def dim_item(self) -> DataFrame:
        return marts.dim_item(self.items, self.categories)


def for_driver(df: DataFrame) -> DataFrame:
    """Render exact decimals as doubles for the cross-engine comparison (the decimal
    arithmetic itself stays exact; only the final value is converted)."""
    cols = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DecimalType):
            cols.append(F.col(field.name).cast("double").alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)
