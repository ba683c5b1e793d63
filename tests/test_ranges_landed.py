"""Interval join by bins, landed records with typed keys, snapshots laid out by run."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators.load import incremental_filter, load_job, read_table
from ledgerflow.operators.infer import infer_schema
from ledgerflow.operators.ranges import interval_join
from ledgerflow.operators.runs import RUNS_SCHEMA, append_snapshot, read_snapshot
from ledgerflow.sources.landed import KEY, Landed, land
from ledgerflow.sources.records import records_from_python
from ledgerflow.spec import IncrementalSpec, JobSpec

JOB = JobSpec("shop", "sales", ("id",), IncrementalSpec("at", "2024-01-01 00:00:00", "%Y-%m-%d %H:%M:%S"))
SECONDS = JobSpec("shop", "ticks", ("id",), IncrementalSpec("at", "0", "epoch"))


def at(hour):
    return dt.datetime(2024, 1, 1, hour, tzinfo=dt.UTC)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_interval_join_equals_all_pairs(spark, width):
    rng = random.Random(width)
    points = [(rng.choice([None, *range(-40, 60)]), n) for n in range(80)]
    spans = [(rng.choice([None, *range(-90, 90)]), rng.choice([None, None, *range(-90, 90)]), n) for n in range(60)]
    p, s = spark.createDataFrame(points, "at int, p int"), spark.createDataFrame(spans, "a int, b int, s int")
    joined = interval_join(p, s, F.col("at"), F.col("a"), F.col("b"), width)
    want = sorted((x, y) for v, x in points for a, b, y in spans if v is not None and a is not None and a <= v and (b is None or v <= b))
    assert sorted((r["p"], r["s"]) for r in joined.collect()) == want
    assert joined.columns == ["at", "p", "a", "b", "s"]
    plan = plan_of(joined)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    for empty in (interval_join(p.limit(0), s, F.col("at"), F.col("a"), F.col("b"), width),
                  interval_join(p, s.limit(0), F.col("at"), F.col("a"), F.col("b"), width)):
        assert empty.collect() == []


def sales(spark, *rows):
    return records_from_python(spark, [{"id": n, **r} for n, r in enumerate(rows, 1)])


def test_the_bound_reaches_the_scan(spark, tmp_path):
    records = sales(spark, {"at": "2024-01-01 08:00:00"}, {"at": "2024-01-01 09:00:00"}, {"at": "2024-01-01 10:00:00"}, {"at": None}, {})
    path = str(tmp_path / "landed")
    land(records, JOB, path, "day1")
    land(records.limit(0), JOB, path, "day2")
    for exclusive in (False, True):
        for bound in (None, at(9), at(11)):
            got = Landed(path).since(spark, JOB, bound, exclusive)
            want = incremental_filter(records, JOB, bound, exclusive)
            assert sorted(r["ordinal"] for r in got.collect()) == sorted(r["ordinal"] for r in want.collect())
    plan = plan_of(Landed(path).since(spark, JOB, at(9)))
    pushed = plan[plan.index("PushedFilters"):].split("\n")[0]
    assert f"GreaterThanOrEqual({KEY}," in pushed


def test_row_groups_below_the_bound_are_not_read(spark, tmp_path):
    path = str(tmp_path / "landed")
    many = spark.range(60_000).select(F.col("id").alias("ordinal"), F.parse_json(F.format_string('{"id":%d,"at":%d,"pad":"%s"}', "id", "id", F.repeat(F.lit("x"), 80))).alias("record"))
    spark.conf.set("parquet.block.size", 256 * 1024)
    try:
        land(many.orderBy(F.rand(1)).coalesce(1), SECONDS, path, "day1")
    finally:
        spark.conf.unset("parquet.block.size")
    late = Landed(path).since(spark, SECONDS, dt.datetime.fromtimestamp(59_000, dt.UTC))
    assert late.count() == 1000
    import pyarrow.parquet as pq

    file = pq.ParquetFile(next((tmp_path / "landed").rglob("*.parquet")))
    assert file.num_row_groups > 4
    column = file.schema_arrow.names.index(KEY)
    least = [file.metadata.row_group(g) for g in range(file.num_row_groups)]
    tops = [g.column(next(c for c in range(g.num_columns) if g.column(c).path_in_schema == KEY)).statistics.max for g in least]
    assert column >= 0 and tops == sorted(tops) and sum(t >= 59_000_000_000 for t in tops) <= 2


def test_unreadable_keys_fail_the_read_and_late_records_are_found(spark, tmp_path):
    path = str(tmp_path / "landed")
    land(sales(spark, {"at": "2024-01-01 10:00:00"}), JOB, path, "day1")
    land(sales(spark, {"at": "2024-01-01 09:30:00"}), JOB, path, "day2")  # late
    assert Landed(path).since(spark, JOB, at(9)).count() == 2
    land(sales(spark, {"at": "yesterday"}), JOB, path, "day3")
    with pytest.raises(Exception, match="at does not match the job format: yesterday"):
        Landed(path).since(spark, JOB, at(9)).collect()
    land(sales(spark, {"at": "2024-01-01 08:00:00"}), JOB, path, "day3")  # landed again, mended
    assert Landed(path).since(spark, JOB, at(9)).count() == 2


def test_a_job_loads_from_typed_keys(spark, tmp_path):
    path, warehouse = str(tmp_path / "landed"), str(tmp_path / "warehouse")
    first = sales(spark, {"at": "2024-01-01 08:00:00", "v": 1}, {"at": "2024-01-01 09:00:00", "v": 2})
    schema = infer_schema(first, JOB)
    land(first, JOB, path, "day1")
    assert load_job(spark, Landed(path), JOB, schema, warehouse).records_loaded == 2
    second = records_from_python(spark, [{"id": 2, "at": "2024-01-01 10:00:00", "v": 3}]).withColumn("ordinal", F.lit(9).cast("long"))
    land(second, JOB, path, "day2")
    run = load_job(spark, Landed(path), JOB, schema, warehouse)
    assert (run.records_loaded, run.max_incremental_value) == (2, "2024-01-01 10:00:00")
    assert {(r["id"], r["v"]) for r in read_table(spark, warehouse, "shop", "sales").collect()} == {(1, 1), (2, 3)}


def test_the_latest_run_prunes_the_scan(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    day = lambda n: dt.datetime(2024, 1, n, tzinfo=dt.UTC)
    log = []
    for n, status in enumerate(["succeeded", "succeeded", "failed"], 1):
        append_snapshot(spark.range(10 * n).withColumnRenamed("id", "key"), path, f"run-{n}")
        log.append((f"run-{n}", "c", "job", status, day(n), day(n), None, None, None, None))
    runs = spark.createDataFrame(log, RUNS_SCHEMA)
    got = read_snapshot(spark, path, runs, "job")
    assert got.count() == 20 and {r[0] for r in got.select("_run_id").distinct().collect()} == {"run-2"}
    plan = plan_of(got)
    assert "dynamicpruning" in plan[plan.index("PartitionFilters"):].split("\n")[0]
    append_snapshot(spark.range(3).withColumnRenamed("id", "key"), path, "run-2")  # the same run again
    assert read_snapshot(spark, path, runs, "job").count() == 3 and read_snapshot(spark, path, runs, "other").count() == 0
