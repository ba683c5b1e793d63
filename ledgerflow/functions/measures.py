"""Measure registry (G5, M1-M18): named aggregates usable at any grain.

A measure is either a base sum over one fact column, or an expression over other
measures (ratios use DIVIDE semantics: blank when the denominator is zero or blank).
Ratios are always recomputed from the sums at each grain, never averaged.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    name: str
    fact: str | None = None  # base measures: the fact they sum over
    column: str | None = None  # base measures: the summed column
    inputs: tuple[str, ...] = field(default_factory=tuple)  # derived: measures used
    combine: Callable[..., Column] | None = None  # derived: f(*input columns)

    @property
    def is_base(self) -> bool:
        return self.fact is not None


def divide(num: Column, den: Column) -> Column:
    """DAX DIVIDE: num / den as a double, blank (NULL) when den is zero or blank."""
    d = den.cast("double")
    return F.when(d.isNull() | (d == 0), F.lit(None).cast("double")).otherwise(num.cast("double") / d)


TE, CAP, PM = "time_entries", "capacity", "project_margin"

MEASURES: dict[str, Measure] = {
    m.name: m
    for m in [
        Measure("Total Hours", TE, "hours"),
        Measure("Worked Hours", TE, "worked_hours"),
        Measure("Client Hours", TE, "client_facing_hours"),
        Measure("Exempt Hours", TE, "exempt_hours"),
        Measure("Project Work Hours", TE, "project_work_hours"),
        Measure("Client BD Hours", TE, "client_bd_hours"),
        Measure("Internal Productive Hours", TE, "internal_productive_hours"),
        Measure("Internal Admin Hours", TE, "internal_admin_hours"),
        Measure("Expected Hours", CAP, "expected_hours"),
        Measure("Standard Hours", CAP, "standard_hours"),
        Measure("Net Utilization %", inputs=("Worked Hours", "Expected Hours"), combine=divide),
        Measure("Project Work %", inputs=("Project Work Hours", "Expected Hours"), combine=divide),
        Measure("Client BD %", inputs=("Client BD Hours", "Expected Hours"), combine=divide),
        Measure(
            "Internal %",
            inputs=("Internal Productive Hours", "Internal Admin Hours", "Expected Hours"),
            combine=lambda a, b, e: divide(a + b, e),
        ),
        Measure("Exempt %", inputs=("Exempt Hours", "Standard Hours"), combine=divide),
        Measure("Price", PM, "price"),
        Measure("Net Revenue", PM, "net_revenue"),
        Measure("Project Profit", PM, "project_profit"),
        Measure("Project Profit %", inputs=("Project Profit", "Net Revenue"), combine=divide),
        Measure("Contribution Margin", PM, "contribution_margin"),
        Measure("Contribution Margin %", inputs=("Contribution Margin", "Net Revenue"), combine=divide),
    ]
}
# "Client Rank" (M12) is positional, not an aggregate: see ledgerflow.plans.pages.client_rank.


def base_measures(names: list[str]) -> list[Measure]:
    """All base measures the named measures depend on, in first-use order."""
    seen: dict[str, Measure] = {}

    def visit(name: str) -> None:
        m = MEASURES[name]
        if m.is_base:
            seen.setdefault(name, m)
        for i in m.inputs:
            visit(i)

    for n in names:
        visit(n)
    return list(seen.values())


def slug(name: str) -> str:
    """Column name of a measure: 'Net Utilization %' -> 'net_utilization_pct'."""
    return name.lower().replace(" %", "_pct").replace("%", "pct").replace(" ", "_")


def measure_column(name: str) -> Column:
    """The Column for measure ``name`` over a frame that holds every base measure as a
    column named ``slug(name)``."""
    m = MEASURES[name]
    if m.is_base:
        return F.col(slug(name))
    return m.combine(*[measure_column(i) for i in m.inputs])
