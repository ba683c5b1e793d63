import pytest
import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from helpers import frame
from ledgerflow.operators.infer import infer_schema
from ledgerflow.operators.load import load_job, read_table
from ledgerflow.operators.ranking import global_rank
from ledgerflow.plans import pages
from ledgerflow.sources.records import read_json_lines
from ledgerflow.spec import JobSpec
from ledgerflow.streaming.upsert import stream_upsert

HOURS = ("hours decimal(8,2), worked_hours decimal(8,2), client_facing_hours decimal(8,2), "
         "project_work_hours decimal(8,2), client_bd_hours decimal(8,2), internal_productive_hours decimal(8,2), "
         "internal_admin_hours decimal(8,2), exempt_hours decimal(8,2)")


def star(spark):
    te = frame(spark, [
        {"entry_date": "2026-03-02", "employee_id": 1, "client_id": 10, "hours": 8, "worked_hours": 8, "client_facing_hours": 8},
        {"entry_date": "2026-03-03", "employee_id": 1, "client_id": 11, "hours": 4, "worked_hours": 4, "client_facing_hours": 2},
        {"entry_date": "2026-03-03", "employee_id": 2, "client_id": 10, "hours": 2, "worked_hours": 2, "client_facing_hours": 2},
        {"entry_date": "2026-03-03", "employee_id": 2, "client_id": 99, "hours": 1, "worked_hours": 1, "client_facing_hours": 1},
    ], "entry_date date, employee_id int, client_id int, project_id int, item_id int, " + HOURS)
    cap = frame(spark, [
        {"date_day": "2026-03-02", "employee_id": 1, "expected_hours": 8, "standard_hours": 8},
        {"date_day": "2026-03-03", "employee_id": 1, "expected_hours": 8, "standard_hours": 8},
        {"date_day": "2026-03-03", "employee_id": 2, "expected_hours": 0, "standard_hours": 8},
    ], "date_day date, employee_id int, expected_hours decimal(8,2), standard_hours decimal(8,2)")
    date = frame(spark, [{"date_day": "2026-03-02", "week_start": "2026-03-01"}, {"date_day": "2026-03-03", "week_start": "2026-03-01"}],
                 "date_day date, week_start date")
    emp = frame(spark, [{"employee_id": 1, "employee_name": "A", "department_name": "D1", "group_name": "G"},
                        {"employee_id": 2, "employee_name": "B", "department_name": "D2", "group_name": "G"}],
                "employee_id int, employee_name string, department_name string, group_name string")
    cli = frame(spark, [{"client_id": 10, "client_name": "X", "is_internal": False},
                        {"client_id": 11, "client_name": "Y", "is_internal": False}],
                "client_id int, client_name string, is_internal boolean")
    empty = frame(spark, [], "project_id int, project_display_name string, department_name string")
    items = frame(spark, [], "item_id int, item_name string")
    return pages.Star(facts={"time_entries": te, "capacity": cap},
                      dims={"date": date, "employee": emp, "client": cli, "project": empty, "item": items})


def test_ratios_are_recomputed_per_level_never_averaged(spark):
    out = pages.pivot(star(spark), [("employee", "group_name"), ("employee", "employee_name")],
                      ["Net Utilization %", "Total Hours"])
    rows = {(r.group_name, r.employee_name, r.grouping_level): r for r in out.collect()}
    assert rows[("G", "A", 0)].net_utilization_pct == 12 / 16
    assert rows[("G", "B", 0)].net_utilization_pct is None  # zero expected hours -> blank
    assert rows[("G", None, 1)].net_utilization_pct == 15 / 16  # not the mean of the leaves
    assert rows[(None, None, 3)].total_hours == 15


def test_slicer_filters_only_reach_related_facts_and_rank(spark):
    s = star(spark)
    out = pages.pivot(s, [("client", "client_name"), ("employee", "employee_name")],
                      ["Client Hours", "Client Rank"], {("client", "client_name"): ["X", "Y"]})
    rows = {(r.client_name, r.employee_name): r for r in out.collect()}
    assert rows[("X", None)].client_rank == 1 and rows[("Y", None)].client_rank == 2
    assert rows[(None, None)].client_rank is None  # client rolled up: blank
    assert rows[("X", "B")].client_rank == 1  # ranked among clients in B's context
    assert rows[(None, None)].client_hours == 12  # client 99 (no dimension row) is filtered out


def test_global_rank_matches_sql_rank(spark):
    df = spark.createDataFrame([(i, (i * 7) % 13) for i in range(500)], "id int, v int")
    ours = {r.id: r.rank for r in global_rank(df, ["v"], num_partitions=7).collect()}
    df.createOrReplaceTempView("gr")
    sql = {r.id: r.rank for r in spark.sql("select id, rank() over (order by v desc) as rank from gr").collect()}
    assert ours == sql


def test_global_rank_hot_value_and_nulls(spark):
    # a third of the rows share one value; NULLs sort last (descending) and tie together
    rows = [(i, 5 if i % 3 == 0 else (None if i % 7 == 0 else i)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, v int")
    ours = {r.id: r.rank for r in global_rank(df, ["v"], num_partitions=5).collect()}
    df.createOrReplaceTempView("gr2")
    sql = {r.id: r.rank for r in spark.sql("select id, rank() over (order by v desc nulls last) as rank from gr2").collect()}
    assert ours == sql
    asc = {r.id: r.rank for r in global_rank(df, ["v"], descending=False, nulls_first=True).collect()}
    sql2 = {r.id: r.rank for r in spark.sql("select id, rank() over (order by v asc nulls first) as rank from gr2").collect()}
    assert asc == sql2


def test_stream_upsert_equals_batch(spark):
    landing = tempfile.mkdtemp(prefix="land-", dir="/tmp")
    rows = [{"k": i % 7, "v": i} for i in range(60)]
    for page in range(3):
        os.makedirs(f"{landing}/page={page}")
        with open(f"{landing}/page={page}/part.txt", "w") as fh:
            for r in rows[page * 20:(page + 1) * 20]:
                fh.write(json.dumps(r) + "\n")
    spec = JobSpec("s", "t", ("k",))
    recs = read_json_lines(spark, landing)
    schema = infer_schema(recs, spec, checkpoint=False)
    batch_wh = tempfile.mkdtemp(prefix="wh-b-", dir="/tmp")
    load_job(spark, recs, spec, schema, batch_wh)
    stream_wh = tempfile.mkdtemp(prefix="wh-s-", dir="/tmp")
    q = stream_upsert(spark, landing, spec, schema, stream_wh, checkpoint=tempfile.mkdtemp(prefix="ck-", dir="/tmp"))
    q.awaitTermination()
    batch = sorted((r.k, r.v) for r in read_table(spark, batch_wh, "s", "t").collect())
    stream = sorted((r.k, r.v) for r in read_table(spark, stream_wh, "s", "t").collect())
    assert batch == stream == [(k, max(i for i in range(60) if i % 7 == k)) for k in range(7)]


def test_grouped_rank_matches_sql_rank_with_hot_group_and_null_group(spark):
    # group 0 holds a third of the rows; a NULL group; ties and NULL values inside groups
    rows = [(i, None if i % 11 == 0 else (0 if i % 3 == 0 else i % 5),
             None if i % 13 == 0 else (i * 7) % 17) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, g int, v int")
    ours = {r.id: r.rank for r in global_rank(df, ["v"], num_partitions=6, partition_by=["g"]).collect()}
    df.createOrReplaceTempView("gr3")
    sql = {r.id: r.rank for r in spark.sql(
        "select id, rank() over (partition by g order by v desc nulls last) as rank from gr3").collect()}
    assert ours == sql


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_rank_bounds_agree_when_keys_are_sampled(spark, reuse):
    # enough distinct keys that the range bounds come from a sample, not from all keys;
    # local ranks and per-partition offsets must use the same bounds with or without
    # exchange reuse
    before = spark.conf.get("spark.sql.exchange.reuse", "true")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        df = spark.range(0, 300_000, numPartitions=8).selectExpr("id", "id % 3 as g", "(id * 7919) % 100003 as v")
        ours = global_rank(df, ["v"], partition_by=["g"], num_partitions=8).select("id", F.col("rank").alias("r1"))
        df.createOrReplaceTempView("sampled")
        sql = spark.sql("select id, rank() over (partition by g order by v desc) as r2 from sampled")
        assert ours.join(sql, "id").filter("r1 <> r2").count() == 0
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)


def test_restarted_stream_resumes_from_its_checkpoint(spark):
    from ledgerflow.operators.load import read_runs

    landing = tempfile.mkdtemp(prefix="land-r-", dir="/tmp")
    ckpt = tempfile.mkdtemp(prefix="ck-r-", dir="/tmp")
    wh = tempfile.mkdtemp(prefix="wh-r-", dir="/tmp")
    spec = JobSpec("s", "t", ("k",))

    def land(page, rows):
        os.makedirs(f"{landing}/page={page}")
        with open(f"{landing}/page={page}/part.txt", "w") as fh:
            for r in rows:
                fh.write(json.dumps(r) + "\n")

    land(0, [{"k": i % 3, "v": i} for i in range(6)])
    schema = infer_schema(read_json_lines(spark, landing), spec, checkpoint=False)
    stream_upsert(spark, landing, spec, schema, wh, checkpoint=ckpt).awaitTermination()
    land(1, [{"k": 1, "v": 100}, {"k": 7, "v": 7}])
    # a new query on the same checkpoint reads only the page landed since
    stream_upsert(spark, landing, spec, schema, wh, checkpoint=ckpt).awaitTermination()
    table = sorted((r.k, r.v) for r in read_table(spark, wh, "s", "t").collect())
    assert table == [(0, 3), (1, 100), (2, 5), (7, 7)]
    runs = read_runs(spark, wh, "s").filter("status = 'succeeded'").collect()
    assert sorted(r.records_loaded for r in runs) == [2, 6]
