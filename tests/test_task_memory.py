"""What one task holds of the reports."""

from collections import Counter

from pyspark.sql import functions as F

from helpers import frame
from ledgerflow.plans import reporting
from ledgerflow.plans.standins import StandIns
from ledgerflow.session import configure
from ledgerflow.sources import seeds

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_entries_without_a_project_are_spread(spark):
    """all of them met in one task of the join, and of the aggregate behind it."""
    entries = spark.range(4000).select(
        F.lit("2024-01-05").cast("date").alias("entry_date"), (F.col("id") % 500).cast("int").alias("employee_id"),
        F.when(F.col("id") % 100 == 0, F.lit(7)).cast("int").alias("project_id"), (F.col("id") % 50).cast("int").alias("client_id"),
        (F.col("id") % 3).cast("int").alias("item_id"), F.lit(1).cast("decimal(8,2)").alias("hours"))
    emp = frame(spark, [{"employee_id": n, "employee_name": f"e{n}"} for n in range(500)], "employee_id int, employee_name string, department_name string")
    prj = frame(spark, [{"project_id": 7, "project_display_name": "P7", "client_name": "c of P7"}, {"project_display_name": "no id"}],
                "project_id int, project_display_name string, department_name string, client_name string")
    cli = frame(spark, [{"client_id": n, "client_name": f"c{n}"} for n in range(50)], "client_id int, client_name string")
    itm = frame(spark, [{"item_id": n, "item_name": f"i{n}"} for n in range(3)], "item_id int, item_name string, category_name string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for k, v in zip(before, ("-1", "false", "8")):
        spark.conf.set(k, v)
    try:
        out = reporting.task_breakdown(entries, emp, prj, cli, itm)
        shares = Counter(r["p"] for r in out.where("project_id is null").select(F.spark_partition_id().alias("p")).collect())
        rows = out.collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(shares.values()) < sum(shares.values()) / 2
    assert sum(r["hours"] for r in rows) == 4000 and sum(r["hours"] for r in rows if r["project_id"] == 7) == 40
    assert {(r["project_display_name"], r["client_name"]) for r in rows if r["project_id"] == 7} == {("P7", "c of P7")}
    assert {r["project_display_name"] for r in rows if r["project_id"] is None} == {None}


def test_fixed_rows_have_a_known_size(spark):
    """five items of unknown size made every entry cross a shuffle by item."""
    s = StandIns(spark, SF)
    assert "LocalRelation" in plan(seeds.literal(spark, [(1, None)], "a int, b string")) and seeds.literal(spark, [(1, None)], "a int, b string").collect() == [(1, None)]
    chosen = s.bucketed._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in chosen and "BroadcastHashJoin" in chosen


def test_shares_of_a_shuffle_are_bounded_unless_set(spark):
    """64 MB of shuffled bytes are over a gigabyte in a task's sorts."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    fresh = spark.newSession()
    assert configure(fresh).conf.get(key) == "16m"
    fresh.conf.set(key, "5m")
    assert configure(fresh).conf.get(key) == "5m"
