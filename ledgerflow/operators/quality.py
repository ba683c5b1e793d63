"""Data-quality checks and schema contracts (Q1-Q9).

Each check yields its failing rows as a DataFrame; ``run_checks`` turns a list of checks
into one summary frame ``(check, severity, failures, status)`` and reads each table once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.scalars import instant


@dataclass(frozen=True)
class Check:
    name: str
    table: str
    kind: str  # unique | not_null | accepted_values | relationships | unique_combination | freshness | expression
    columns: tuple[str, ...] = ()
    params: dict[str, Any] = field(default_factory=dict)
    severity: str = "error"  # error | warn


def unique(df: DataFrame, column: str) -> DataFrame:
    """Q1: values that occur more than once (NULLs ignored)."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Q2: rows where the column is NULL."""
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Q3: rows whose value is outside the list (NULLs pass)."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def _parent_keys(parent: DataFrame, parent_column: str) -> DataFrame:
    # distinct (a partial aggregate), so a parent key repeated many times is one row on
    # the build side of the anti join
    return parent.select(F.col(parent_column).alias("__parent_key")).distinct()


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key has no parent (NULL keys pass); an anti join."""
    return child.filter(F.col(column).isNotNull()).join(
        _parent_keys(parent, parent_column), F.col(column) == F.col("__parent_key"), "left_anti"
    )


def orphan_count(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """One-row count of ``relationships`` failures. Child rows are first counted per key
    (map-side), so a key held by a third of the child rows is one row in the join."""
    per_key = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    orphans = per_key.join(_parent_keys(parent, parent_column), F.col(column) == F.col("__parent_key"), "left_anti")
    return orphans.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("failures"))


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q5/A10: combinations that occur more than once (count > 1)."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)


def freshness(df: DataFrame, loaded_at: str, now: datetime, warn_after_hours: float = 36) -> DataFrame:
    """Q7: one row (latest, age_hours, is_stale) comparing max(loaded_at) with ``now``."""
    latest = F.max(F.col(loaded_at).cast("timestamp")).alias("latest_loaded_at")
    now_col = instant(now)
    age = (F.unix_micros(now_col) - F.unix_micros(F.col("latest_loaded_at"))) / F.lit(3_600_000_000.0)
    return df.agg(latest).select("latest_loaded_at", age.alias("age_hours")).withColumn("is_stale", F.coalesce(F.col("age_hours") > F.lit(warn_after_hours), F.lit(True)))


def uncategorized_items(entries: DataFrame) -> DataFrame:
    """Logged items the category seed does not map (severity warn)."""
    return (
        entries.filter(F.col("category_code") == "unmapped")
        .groupBy("item_name")
        .agg(F.count(F.lit(1)).alias("entries"), F.sum("hours").alias("hours"))
    )


def failing_rows(tables: dict[str, DataFrame], check: Check) -> DataFrame:
    df = tables[check.table]
    if check.kind == "unique":
        return unique(df, check.columns[0])
    if check.kind == "not_null":
        return not_null(df, check.columns[0])
    if check.kind == "accepted_values":
        return accepted_values(df, check.columns[0], check.params["values"])
    if check.kind == "relationships":
        return relationships(df, check.columns[0], tables[check.params["to"]], check.params["field"])
    if check.kind == "unique_combination":
        return unique_combination(df, check.columns)
    if check.kind == "freshness":
        return freshness(df, check.columns[0], check.params["now"], check.params.get("warn_after_hours", 36)).filter(
            "is_stale"
        )
    if check.kind == "expression":
        return df.filter(~F.coalesce(F.expr(check.params["expr"]), F.lit(False)))
    raise ValueError(f"unknown check kind {check.kind!r}")


def _key_text(column: Column, kind: T.DataType) -> Column:
    """A key in a form that is equal for equal keys of the two sides of a relationship."""
    if isinstance(kind, T.IntegralType):
        return column.cast("long").cast("string")
    if isinstance(kind, T.DecimalType):
        return column.cast("decimal(38,10)").cast("string")
    return F.hex(column) if isinstance(kind, T.BinaryType) else column.cast("string")


_ENTRY = "struct<check:int,key:array<string>,n:bigint,parent:boolean>"


def _entry(number: int, key: Column | None, n: Column, parent: bool = False) -> Column:
    fields = (F.lit(number), F.lit(None) if key is None else key, n, F.lit(parent))
    return F.struct(*fields).cast(_ENTRY)


def _table_entries(df: DataFrame, keys: dict[tuple[str, ...], list[tuple[int, str]]], rows: list[tuple[int, Column]]) -> DataFrame:
    """Everything that the checks of one table need, from one reading of it: ``keys`` says
    which checks want the distinct values of which columns, and in what part; ``rows`` are
    conditions on a row that a check counts.

    All sets of key columns and the whole table are the grouping sets of one aggregate, so a
    key that a third of all rows hold is one row per task before the shuffle."""
    names = list(dict.fromkeys(c for columns in keys for c in columns))
    held = {c: f"__key{k}" for k, c in enumerate(names)}
    kinds = {c: df.schema[c].dataType for c in names}
    keyed = df.withColumns({held[c]: F.col(f"`{c}`") for c in names})
    counted = [F.count(F.lit(1)).alias("__n"), *[F.count_if(bad).alias(f"__bad{k}") for k, (_, bad) in enumerate(rows)]]
    whole = [_entry(number, None, F.col(f"__bad{k}")) for k, (number, _) in enumerate(rows)]
    if not keys:
        return df.agg(*counted).select(F.explode(F.array(*whole)).alias("e")).select("e.*")
    sets = [[F.col(held[c]) for c in columns] for columns in keys]
    grouped = keyed.groupingSets(sets + ([[]] if rows else []), *[F.col(held[c]) for c in names]).agg(
        F.grouping_id().alias("__set"), *counted)
    wanted = F.when(F.lit(False), F.array().cast(f"array<{_ENTRY}>"))
    n = F.col("__n")
    for columns, parts in keys.items():
        number = sum(1 << (len(names) - 1 - k) for k, c in enumerate(names) if c not in columns)
        key = F.array(*[_key_text(F.col(held[c]), kinds[c]) for c in columns])
        full = reduce(lambda a, b: a & b, [F.col(held[c]).isNotNull() for c in columns])
        entries = []
        for check, part in parts:
            if part == "combination":
                entries.append(F.when(n > 1, _entry(check, None, F.lit(1))))
            elif part == "unique":
                entries.append(F.when(full & (n > 1), _entry(check, None, F.lit(1))))
            else:
                entries.append(F.when(full, _entry(check, key, n if part == "child" else F.lit(0), part == "parent")))
        wanted = wanted.when(F.col("__set") == number, F.array_compact(F.array(*entries)))
    if rows:
        wanted = wanted.when(F.col("__set") == (1 << len(names)) - 1, F.array(*whole))
    return grouped.select(F.explode(wanted).alias("e")).select("e.*")


def run_checks(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Q9: summary ``check, severity, failures, status`` of all checks, each table read once.

    A table's uniqueness checks, relationship keys and row conditions are one aggregate over
    grouping sets. What it finds of all tables meets in one more aggregate by (check, key):
    there a relationship's child keys are counted as failures unless a parent has them, so
    no table is joined. Tables that are one and the same frame are read as one."""
    spark: SparkSession = next(iter(tables.values())).sparkSession
    frames: dict[int, DataFrame] = {id(df): df for df in tables.values()}
    keys: dict[int, dict[tuple[str, ...], list[tuple[int, str]]]] = {}
    rows: dict[int, list[tuple[int, Column]]] = {}
    parts: list[DataFrame] = []

    def want(table: str, columns: tuple[str, ...], number: int, part: str) -> None:
        keys.setdefault(id(tables[table]), {}).setdefault(columns, []).append((number, part))

    for number, c in enumerate(checks):
        column = F.col(f"`{c.columns[0]}`") if c.columns else None
        if c.kind == "unique":
            want(c.table, (c.columns[0],), number, "unique")
        elif c.kind == "unique_combination":
            want(c.table, tuple(c.columns), number, "combination")
        elif c.kind == "relationships":
            want(c.table, (c.columns[0],), number, "child")
            want(c.params["to"], (c.params["field"],), number, "parent")
        elif c.kind in ("not_null", "accepted_values", "expression"):
            bad = {"not_null": lambda: column.isNull(),
                   "accepted_values": lambda: column.isNotNull() & ~column.isin(*c.params["values"]),
                   "expression": lambda: ~F.coalesce(F.expr(c.params["expr"]), F.lit(False))}[c.kind]()
            rows.setdefault(id(tables[c.table]), []).append((number, bad))
        else:
            found = failing_rows(tables, c).agg(F.count(F.lit(1)).alias("n"))
            parts.append(found.select(_entry(number, None, F.col("n")).alias("e")).select("e.*"))
    parts += [_table_entries(df, keys.get(k, {}), rows.get(k, [])) for k, df in frames.items() if k in keys or k in rows]
    listed = spark.createDataFrame([(n, c.name, c.severity) for n, c in enumerate(checks)], "number int, name string, severity string")
    if not parts:
        return listed.select(F.col("name").alias("check"), "severity", F.lit(0).cast("bigint").alias("failures"), F.lit("pass").alias("status"))
    per_key = reduce(DataFrame.unionByName, parts).groupBy("check", "key").agg(F.sum("n").alias("n"), F.bool_or("parent").alias("parent"))
    failed = per_key.where(~F.col("parent")).groupBy(F.col("check").alias("number")).agg(F.sum("n").alias("failures"))
    out = listed.join(failed, "number", "left").select(
        F.col("name").alias("check"), "severity", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"))
    return out.withColumn(
        "status",
        F.when(F.col("failures") == 0, F.lit("pass"))
        .when(F.col("severity") == "error", F.lit("fail"))
        .otherwise(F.lit("warn")),
    )


class ContractError(Exception):
    pass


def contract_differences(df: DataFrame, contract: T.StructType) -> list[dict[str, str | None]]:
    """Q8: column-by-column comparison of a frame's schema with a declared contract."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    expected = {f.name: f.dataType.simpleString() for f in contract.fields}
    rows = []
    for name in list(expected) + [n for n in actual if n not in expected]:
        e, a = expected.get(name), actual.get(name)
        problem = None
        if a is None:
            problem = "missing"
        elif e is None:
            problem = "not in contract"
        elif a != e:
            problem = "type mismatch"
        rows.append({"column": name, "expected_type": e, "actual_type": a, "problem": problem})
    return rows


def contract_report(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Q8 as a table: one row per column (name and type comparison) plus, from one
    aggregation pass over the data, how many non-NULL values would not cast strictly to
    the declared type (``uncastable``; NULL where the column is missing on one side) and
    the number of rows checked."""
    rows = contract_differences(df, contract)
    counts = []
    for r in rows:
        if r["expected_type"] and r["actual_type"]:
            c = F.col(f"`{r['column']}`")
            counts.append(F.count_if(c.isNotNull() & c.try_cast(r["expected_type"]).isNull()))
        else:
            counts.append(F.lit(None).cast("bigint"))
    agg = df.agg(F.count(F.lit(1)).alias("__rows"), *[n.alias(f"__u{i}") for i, n in enumerate(counts)])
    text = lambda v: F.lit(v).cast("string")
    entries = F.array(*[
        F.struct(
            text(r["column"]).alias("column"),
            text(r["expected_type"]).alias("expected_type"),
            text(r["actual_type"]).alias("actual_type"),
            text(r["problem"]).alias("problem"),
            F.col(f"__u{i}").cast("bigint").alias("uncastable"),
        )
        for i, r in enumerate(rows)
    ])
    return agg.select(F.explode(entries).alias("r"), F.col("__rows").cast("bigint").alias("rows_checked")).select(
        "r.*", "rows_checked"
    )


def assert_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Enforced contract: return ``df`` unchanged, or fail listing every difference."""
    bad = [r for r in contract_differences(df, contract) if r["problem"]]
    if bad:
        details = "; ".join(f"{r['column']}: {r['problem']} (expected {r['expected_type']}, got {r['actual_type']})" for r in bad)
        raise ContractError(f"contract violated: {details}")
    return df


def schema_drift(fresh: DataFrame, committed: DataFrame) -> DataFrame:
    """Paths whose inferred type, format or nullability changed, or that appear
    on one side only (full outer join on path)."""
    a = fresh.select("path", *[F.col(c).alias(f"fresh_{c}") for c in ("type", "format", "nullable")])
    b = committed.select("path", *[F.col(c).alias(f"committed_{c}") for c in ("type", "format", "nullable")])
    joined = a.join(b, "path", "full")
    differs = reduce(
        lambda x, y: x | y,
        [~F.col(f"fresh_{c}").eqNullSafe(F.col(f"committed_{c}")) for c in ("type", "format", "nullable")],
    )
    return joined.filter(differs)


def set_equal(a: DataFrame, b: DataFrame) -> bool:
    """Multiset equality of two results (exceptAll both ways)."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
