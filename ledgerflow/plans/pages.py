"""BI pages over the star (R11-R15): slicers, rollup matrices with subtotals, drill-
across of two facts, rank within the selection, cards.

A ``Star`` holds facts, dimensions and single-direction many-to-one relationships
(J11). ``pivot`` aggregates each fact needed by the requested measures to the row grain
with ``rollup`` (subtotals; ``grouping_level`` tells the level), joins the per-fact
results on the grain (J12), and evaluates derived measures from the sums at each level.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.measures import base_measures, measure_column, slug
from ledgerflow.operators.ranking import global_rank
from ledgerflow.session import materialize

Attr = tuple[str, str]  # (dimension, attribute)

# The star's relationships (fact, fact column, dimension, key).
RELATIONSHIPS = [
    ("time_entries", "entry_date", "date", "date_day"),
    ("time_entries", "employee_id", "employee", "employee_id"),
    ("time_entries", "client_id", "client", "client_id"),
    ("time_entries", "project_id", "project", "project_id"),
    ("time_entries", "item_id", "item", "item_id"),
    ("capacity", "date_day", "date", "date_day"),
    ("capacity", "employee_id", "employee", "employee_id"),
    ("project_margin", "project_id", "project", "project_id"),
]


@dataclass
class Star:
    facts: dict[str, DataFrame]
    dims: dict[str, DataFrame]
    relationships: list[tuple[str, str, str, str]] = field(default_factory=lambda: list(RELATIONSHIPS))

    def link(self, fact: str, dim: str) -> tuple[str, str] | None:
        for f, fc, d, dk in self.relationships:
            if f == fact and d == dim:
                return fc, dk
        return None


def _alias(rows: Sequence[Attr]) -> list[str]:
    names = [a for _, a in rows]
    return [a if names.count(a) == 1 else f"{d}_{a}" for d, a in rows]


def _filter_column(dim_df: DataFrame, attr: str, spec: Any) -> Column:
    c = dim_df[attr]
    if isinstance(spec, Column):
        return spec
    if isinstance(spec, tuple) and len(spec) == 2:  # inclusive range slicer
        lo, hi = spec
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (c >= F.lit(lo))
        if hi is not None:
            cond = cond & (c <= F.lit(hi))
        return cond
    if isinstance(spec, (list, set, frozenset)):
        return c.isin(*spec)
    return c == F.lit(spec)


def fact_at_grain(
    star: Star,
    fact: str,
    rows: Sequence[Attr],
    filters: dict[Attr, Any] | None = None,
    measure_columns: Sequence[str] = (),
) -> DataFrame:
    """The fact (pruned to its relationship keys and ``measure_columns``) joined to the
    dimensions it needs. Filtered dimensions (slicers, F13) restrict it with an inner
    join; the others are left joins, so unmatched keys form a NULL group. Filters on
    dimensions the fact does not reach are ignored (single direction).

    Row attributes come out under their ``_alias`` names."""
    filters = filters or {}
    needed = {d for d, _ in rows} | {d for d, _ in filters}
    keys = sorted({fc for f, fc, d, _ in star.relationships if f == fact and d in needed})
    # pre-aggregate the fact to its dimension keys (sums are decomposable), so the
    # dimension joins and the rollup's row expansion see one row per key combination
    # instead of one per fact row
    df = star.facts[fact].groupBy(*keys).agg(*[F.sum(c).alias(c) for c in measure_columns])
    aliases = _alias(rows)
    for dim in sorted(needed):
        link = star.link(fact, dim)
        if link is None:
            if dim in {d for d, _ in rows}:
                raise ValueError(f"dimension {dim!r} does not reach fact {fact!r}")
            continue
        fc, dk = link
        attrs = [(a, al) for (d, a), al in zip(rows, aliases) if d == dim]
        ddf = star.dims[dim]
        conds = [_filter_column(ddf, a, spec) for (d, a), spec in filters.items() if d == dim]
        if conds:
            ddf = ddf.filter(reduce(lambda x, y: x & y, conds))
        ddf = ddf.select(F.col(dk).alias(f"__k_{dim}"), *[F.col(a).alias(f"__a_{al}") for a, al in attrs])
        how = "inner" if conds else "left"
        df = df.join(ddf, df[fc] == ddf[f"__k_{dim}"], how).drop(f"__k_{dim}")
    return df.select(
        *[F.col(f"__a_{al}").alias(al) for al in aliases], *measure_columns
    )


def pivot(
    star: Star,
    rows: Sequence[Attr],
    measures: Sequence[str],
    filters: dict[Attr, Any] | None = None,
    subtotals: bool = True,
) -> DataFrame:
    """Matrix of ``measures`` by ``rows`` with rollup subtotals.

    Output: one column per row attribute, ``grouping_level`` (0 = leaf; the grand total
    has all bits set), and one column per measure (``slug`` names)."""
    aliases = _alias(rows)
    rank_requested = "Client Rank" in measures
    value_measures = [m for m in measures if m != "Client Rank"]
    if rank_requested and "Client Hours" not in value_measures:
        value_measures.append("Client Hours")
    bases = base_measures(value_measures)
    by_fact: dict[str, list] = {}
    for m in bases:
        by_fact.setdefault(m.fact, []).append(m)

    per_fact = []
    for fact, ms in by_fact.items():
        df = fact_at_grain(star, fact, rows, filters, sorted({m.column for m in ms}))
        keys = [F.col(a) for a in aliases]
        grouped = df.rollup(*keys) if subtotals else df.groupBy(*keys)
        aggs = [F.sum(m.column).alias(slug(m.name)) for m in ms]
        level = (F.grouping_id(*keys) if aliases and subtotals else F.lit(0)).cast("int")
        per_fact.append(grouped.agg(*aggs, level.alias("grouping_level")))

    def drill_across(a: DataFrame, b: DataFrame) -> DataFrame:
        # full outer join on the grain; NULL-safe so NULL groups and subtotal rows meet
        la, lb = a.alias("a"), b.alias("b")
        cond = F.col("a.grouping_level") == F.col("b.grouping_level")
        for al in aliases:
            cond = cond & F.col(f"a.{al}").eqNullSafe(F.col(f"b.{al}"))
        joined = la.join(lb, cond, "full")
        keep = [F.coalesce(F.col(f"a.{al}"), F.col(f"b.{al}")).alias(al) for al in aliases]
        keep.append(F.coalesce(F.col("a.grouping_level"), F.col("b.grouping_level")).alias("grouping_level"))
        value_cols = [c for c in a.columns + b.columns if c not in set(aliases) | {"grouping_level"}]
        keep += [F.coalesce(F.col(f"a.{c}") if c in a.columns else F.col(f"b.{c}")).alias(c) for c in value_cols]
        return joined.select(*keep)

    out = reduce(drill_across, per_fact)
    out = out.select(
        *aliases,
        "grouping_level",
        *[measure_column(m).alias(slug(m)) for m in value_measures],
    )
    if rank_requested:
        client_attrs = [al for (d, _), al in zip(rows, aliases) if d == "client"]
        if not client_attrs:
            raise ValueError("Client Rank needs a client attribute on the rows")
        out = client_rank(out, aliases, client_attrs[0])
    return out


def client_rank(matrix: DataFrame, aliases: Sequence[str], client_col: str) -> DataFrame:
    """Where the client is in scope, the rank of the row's client among the
    selected clients by Client Hours in the row's context (the other row attributes of
    the same level); blank where the client is rolled up.

    Every context is ranked with the distributed rank (``partition_by`` the level and
    the other attributes), so the client-only level - one context holding every client -
    or a department holding a third of all clients never sorts in a single task.
    """
    # the aggregated matrix is read by three branches below (distinct keys, join-back,
    # rolled-up rows): write it once (one row per output cell, far smaller than the
    # facts) instead of recomputing it from the facts
    matrix = materialize(matrix, "pivot-matrix")
    n = len(aliases)
    pos = list(aliases).index(client_col)
    bit = 1 << (n - 1 - pos)
    in_scope = (F.col("grouping_level").bitwiseAND(F.lit(bit))) == 0
    others = [a for a in aliases if a != client_col]
    ranked = global_rank(
        matrix.filter(in_scope), ["client_hours"], descending=True, nulls_first=False, name="client_rank",
        partition_by=["grouping_level", *others],
    )
    rest = matrix.filter(~in_scope).withColumn("client_rank", F.lit(None).cast("int"))
    return ranked.unionByName(rest)


def slicer_values(dim: DataFrame, attr: str) -> DataFrame:
    """Distinct values of a slicer (A16), in order."""
    return dim.select(attr).distinct().orderBy(attr)


def top_n(matrix: DataFrame, by: str, n: int, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Chart ordering (L5): the first ``n`` rows by ``by`` descending, ties broken by
    ``tie_breakers`` (planned as a distributed take-ordered: per-partition top n, then
    one merge of n rows per partition - no global sort)."""
    return matrix.orderBy(F.col(by).desc_nulls_last(), *[F.col(c) for c in tie_breakers]).limit(n)


# --- the five report pages ----------------------------------------------------------

def utilization_page(star: Star, date_range: tuple[Any, Any] | None = None) -> DataFrame:
    """Group > department > employee > week with five percentages; the grand total
    row is the Net Utilization % card."""
    filters = {("date", "date_day"): date_range} if date_range else {}
    return pivot(
        star,
        [("employee", "group_name"), ("employee", "department_name"), ("employee", "employee_name"),
         ("date", "week_start")],
        ["Net Utilization %", "Exempt %", "Project Work %", "Client BD %", "Internal %"],
        filters,
    )


def time_to_clients_page(star: Star, clients: Sequence[str] | None = None) -> DataFrame:
    """Client > department > employee with Total Hours, Client Hours, Client Rank."""
    filters = {("client", "client_name"): list(clients)} if clients else {}
    return pivot(
        star,
        [("client", "client_name"), ("employee", "department_name"), ("employee", "employee_name")],
        ["Total Hours", "Client Hours", "Client Rank"],
        filters,
    )


def tasks_by_person_page(star: Star, items: Sequence[str] | None = None) -> DataFrame:
    """Project department > project > item > employee, Total Hours."""
    filters = {("item", "item_name"): list(items)} if items else {}
    return pivot(
        star,
        [("project", "department_name"), ("project", "project_display_name"), ("item", "item_name"),
         ("employee", "employee_name")],
        ["Total Hours"],
        filters,
    )


def persons_by_task_page(star: Star, items: Sequence[str] | None = None) -> DataFrame:
    """Employee department > employee > item > project, Total Hours."""
    filters = {("item", "item_name"): list(items)} if items else {}
    return pivot(
        star,
        [("employee", "department_name"), ("employee", "employee_name"), ("item", "item_name"),
         ("project", "project_display_name")],
        ["Total Hours"],
        filters,
    )


def margin_page(margin: DataFrame) -> DataFrame:
    """The project margin table with per-row Project Profit % and Contribution
    Margin %, plus the overall card as the rolled-up row (grouping_level 1)."""
    keys = ["department_name", "project_lead", "client_name", "project_display_name",
            "project_status_label", "project_id"]
    sums = ("total_hours", "price", "travel_cost", "incentive_cost", "field_cost",
            "project_profit", "net_revenue", "contribution_margin")
    # the projects and the card in one pass over the margin rows
    both = margin.groupingSets([keys, []], *keys).agg(
        *[F.sum(c).alias(c) for c in sums], (F.grouping_id(*keys) > 0).cast("int").alias("grouping_level"))
    return both.select(
        *keys,
        "grouping_level",
        "total_hours",
        "price",
        "travel_cost",
        "incentive_cost",
        "field_cost",
        measure_column("Project Profit %").alias("project_profit_pct"),
        measure_column("Contribution Margin %").alias("contribution_margin_pct"),
    )
