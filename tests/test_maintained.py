"""Reports refreshed by touched keys: equal to a rebuild, reading the touched weeks alone."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerflow.functions.scalars import week_start
from ledgerflow.operators.load import read_runs
from ledgerflow.plans import maintained, reporting

DIM_EMP = "employee_id int, employee_name string, department_name string, group_name string"
HOURS = "hours decimal(8,2), client_facing_hours decimal(8,2)"


def facts(spark, path, rows):
    df = spark.createDataFrame(rows, "time_entry_id int, client_id int, employee_id int, entry_date date, h int")
    df = df.select("*", F.col("h").cast("decimal(8,2)").alias("hours"), F.col("h").cast("decimal(8,2)").alias("client_facing_hours"),
                   week_start(F.col("entry_date")).alias("week_start")).drop("h")
    df.write.partitionBy("week_start").parquet(path)
    return spark.read.parquet(path)


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_refreshed_equals_rebuilt_and_empty_keys_go(spark, tmp_path):
    rows = [(n, n % 5, n % 3, day(n % 40), n) for n in range(200)]
    before = facts(spark, str(tmp_path / "before"), [*rows, (900, 7, 1, day(3), 5)])
    # entry 900 moves away from the only key of client 7, entry 10 changes, 1000 is new
    after = facts(spark, str(tmp_path / "after"), [r if r[0] != 10 else (10, 0, 1, day(10), 99) for r in rows] + [(900, 2, 1, day(3), 5), (1000, 3, 2, day(60), 1)])
    clients = spark.createDataFrame([(n, f"c{n}", n == 4) for n in range(8)], "client_id int, client_name string, is_internal boolean")
    people = spark.createDataFrame([(n, f"e{n}", "d", "g") for n in range(3)], DIM_EMP)
    root = str(tmp_path / "reports")
    old, new = (maintained.client_hours(f, clients, people) for f in (before, after))
    maintained.rebuild(spark, old, root, "r1")
    changed = spark.createDataFrame([(10,), (900,), (1000,)], "time_entry_id int")
    touched = maintained.touched_keys(before, after, changed, "time_entry_id", new.keys)
    assert sorted((r[0], r[1]) for r in touched.collect()) == [(0, day(10)), (2, day(3)), (3, day(60)), (7, day(3))]
    maintained.refresh(spark, new, touched, root, "r2")
    maintained.refresh(spark, new, touched, root, "r2")  # the same run again does nothing
    got = maintained.read_report(spark, new, root)
    whole = reporting.client_hours(after, clients, people)
    assert got.exceptAll(whole).isEmpty() and whole.exceptAll(got).isEmpty()
    assert got.where("client_id = 7").isEmpty() and got.where("client_id = 4").isEmpty()
    assert {(r.run_id, r.status) for r in read_runs(spark, root, maintained.REPORTS).collect()} == {("r1", "succeeded"), ("r2", "succeeded")}


def test_a_refresh_reads_the_touched_weeks_only(spark, tmp_path):
    entries = facts(spark, str(tmp_path / "facts"), [(n, n % 5, n % 3, day(n % 60), n) for n in range(300)])
    clients = spark.createDataFrame([(n, f"c{n}", False) for n in range(5)], "client_id int, client_name string, is_internal boolean")
    people = spark.createDataFrame([(n, f"e{n}", "d", "g") for n in range(3)], DIM_EMP)
    spark.createDataFrame([(1, day(1))], "client_id int, entry_date date").write.parquet(str(tmp_path / "touched"))
    touched = spark.read.parquet(str(tmp_path / "touched")).where("client_id >= 0")
    rows = maintained.client_hours(entries, clients, people).build(touched)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.split("\n") if "FileScan" in line and "week_start" in line)
    assert "dynamicpruning" in scan
    assert {(r.client_id, r.entry_date) for r in rows.collect()} == {(1, day(1))}


def test_the_last_row_of_a_report_can_go(spark, tmp_path):
    one = facts(spark, str(tmp_path / "one"), [(1, 1, 1, day(0), 3)])
    none = one.limit(0)
    clients = spark.createDataFrame([(1, "c", False)], "client_id int, client_name string, is_internal boolean")
    people = spark.createDataFrame([(1, "e", "d", "g")], DIM_EMP)
    root = str(tmp_path / "reports")
    maintained.rebuild(spark, maintained.client_hours(one, clients, people), root, "r1")
    report = maintained.client_hours(none, clients, people)
    touched = maintained.touched_keys(one, none, one, "time_entry_id", report.keys)
    maintained.refresh(spark, report, touched, root, "r2")
    left = maintained.read_report(spark, report, root)
    assert left is None or left.isEmpty()
