"""Reports kept up to date by what a load touched.

A report is stored as a table of the load's own kind, keyed by the columns at whose grain it
can be recomputed alone: (employee, week), (client, day), project. After a load only the keys
are recomputed whose facts the load changed - where its rows are now and where their former
versions were, so a corrected entry leaves the key that it moved away from. The facts are
semi-joined with those keys before anything else; facts laid out by week are read for the
touched weeks alone, as the weeks reach the scan as a dynamic partition filter. Only the
report's buckets that hold touched keys are written again, and readers see the refreshed
report when its run is committed.

Facts that a report reads besides the loaded ones (dimensions, the calendar) are taken as
they are; if they change, their keys must be among the touched ones.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.scalars import week_start
from ledgerflow.operators.load import finished_run, logged_run, publish_batch, read_table
from ledgerflow.plans import reporting
from ledgerflow.session import materialize
from ledgerflow.spec import JobSpec

REPORTS = "reports"  # the consumer under which reports are stored


def only(df: DataFrame, touched: DataFrame | None, on: dict[str, str]) -> DataFrame:
    """The rows of ``df`` whose columns (``on``: column -> key) are touched; all without keys."""
    if touched is None:
        return df
    keys = touched.select(*[F.col(k).alias(f"__{k}") for k in on.values()]).distinct()
    # a plain equality reaches a partitioned scan; the key columns are never NULL where it does
    return df.join(keys, reduce(lambda a, b: a & b, [df[c] == keys[f"__{k}"] for c, k in on.items()]), "left_semi")


@dataclass(frozen=True)
class Report:
    """``build`` gives the report's rows for the touched keys (None: all)."""

    name: str
    keys: tuple[str, ...]
    build: Callable[[DataFrame | None], DataFrame]

    @property
    def spec(self) -> JobSpec:
        return JobSpec(REPORTS, self.name, self.keys)


def touched_keys(before: DataFrame, after: DataFrame, changed: DataFrame, pk: str, keys: tuple[str, ...]) -> DataFrame:
    """The report keys of the facts that a load ``changed`` (a column of their primary keys):
    of their versions before it and after it. Facts without a key touch nothing."""
    ids = changed.select(F.col(pk).alias("__pk")).distinct()
    parts = [df.join(ids, df[pk] == F.col("__pk"), "left_semi").select(*keys) for df in (before, after)]
    return parts[0].unionByName(parts[1]).dropna().distinct()


def rebuild(spark: SparkSession, report: Report, root: str, run_id: str) -> None:
    """Store the whole report."""
    _publish(spark, report, None, root, run_id)


def refresh(spark: SparkSession, report: Report, touched: DataFrame, root: str, run_id: str) -> None:
    """Recompute the touched keys of the stored report."""
    _publish(spark, report, materialize(touched.select(*report.keys).distinct(), f"touched-{report.name}"), root, run_id)


def _publish(spark: SparkSession, report: Report, touched: DataFrame | None, root: str, run_id: str) -> None:
    if finished_run(spark, root, report.spec, run_id):
        return
    with logged_run(spark, root, report.spec, run_id, datetime.now(UTC)) as entry:
        rows = materialize(report.build(touched), f"report-{report.name}")
        replaced = rows.select(*report.keys).distinct() if touched is None else touched
        entry["records_loaded"] = rows.count() + (0 if touched is None else touched.count())
        if entry["records_loaded"]:
            publish_batch(spark, rows, report.spec, root, run_id, list(report.keys), replaced=replaced)


def read_report(spark: SparkSession, report: Report, root: str) -> DataFrame | None:
    return read_table(spark, root, REPORTS, report.name)


# --- the reports that can be kept so --------------------------------------------------------

def utilization_weekly(capacity: DataFrame, entries: DataFrame, dim_employee: DataFrame) -> Report:
    """R6 by (employee, week); both facts carry ``week_start``."""
    keys = ("employee_id", "week_start")
    on = {k: k for k in keys}

    def build(touched: DataFrame | None) -> DataFrame:
        return reporting.utilization_weekly(only(capacity, touched, on), only(entries, touched, on), dim_employee)

    return Report("rpt_utilization_weekly", keys, build)


def client_hours(entries: DataFrame, dim_client: DataFrame, dim_employee: DataFrame) -> Report:
    """R8 by (client, day)."""
    keys = ("client_id", "entry_date")

    def build(touched: DataFrame | None) -> DataFrame:
        facts = entries
        if touched is not None and "week_start" in entries.columns:  # the layout of the facts
            weeks = touched.select(week_start(F.col("entry_date")).alias("week")).distinct()
            facts = only(entries, weeks, {"week_start": "week"})
        return reporting.client_hours(only(facts, touched, {k: k for k in keys}), dim_client, dim_employee)

    return Report("rpt_client_hours", keys, build)


def project_margin(dim_project: DataFrame, financials: DataFrame | Callable[[DataFrame | None], DataFrame],
                   entries: DataFrame) -> Report:
    """R7 by project. ``financials`` may be a function that gives the lines of the touched
    projects (None: all), where they can be found before what they are joined from is read."""
    on = {"project_id": "project_id"}

    def build(touched: DataFrame | None) -> DataFrame:
        lines = only(financials, touched, on) if isinstance(financials, DataFrame) else financials(touched)
        return reporting.project_margin(only(dim_project, touched, on), lines, only(entries, touched, on))

    return Report("rpt_project_margin", ("project_id",), build)
