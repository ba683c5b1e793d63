"""Runs that are started again, replayed micro-batches, the folded log, buckets by size."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import load
from ledgerflow.operators.infer import infer_schema
from ledgerflow.operators.load import fold_runs, load_job, publish_batch, read_runs, read_table, record_run
from ledgerflow.sources.records import records_from_python
from ledgerflow.spec import JobSpec
from ledgerflow.streaming.upsert import epoch_run, stream_upsert

SPEC = JobSpec("s", "t", ("k",))


def land(folder, page, rows):
    (folder / f"page={page}").mkdir(parents=True)
    (folder / f"page={page}" / "part.txt").write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_a_replayed_epoch_finds_its_run(spark, tmp_path):
    landing, state, warehouse = tmp_path / "landing", str(tmp_path / "state"), str(tmp_path / "warehouse")
    land(landing, 0, [{"k": i % 3, "v": i} for i in range(6)])
    schema = infer_schema(records_from_python(spark, [{"k": 1, "v": 1}]), SPEC)

    def run():
        stream_upsert(spark, str(landing), SPEC, schema, warehouse, checkpoint=state).awaitTermination()
        table = sorted((r.k, r.v) for r in read_table(spark, warehouse, "s", "t").collect())
        return table, sorted((r.run_id, r.status, r.records_loaded) for r in read_runs(spark, warehouse, "s").collect())

    first = run()
    assert first == ([(0, 3), (1, 4), (2, 5)], [(epoch_run(state, 0), "succeeded", 6)])
    states = spark.read.parquet(f"{warehouse}/s/_runs").count()
    # Spark died after the load and before its own commit: the epoch comes again
    for commit in (tmp_path / "state" / "commits").iterdir():
        if commit.name.lstrip(".").startswith("0"):
            commit.unlink()
    assert run() == first and spark.read.parquet(f"{warehouse}/s/_runs").count() == states
    land(landing, 1, [{"k": 1, "v": 100}])
    table, runs = run()
    assert table == [(0, 3), (1, 100), (2, 5)] and [r[0] for r in runs] == [epoch_run(state, n) for n in (0, 1)]


def test_a_broken_attempt_is_replaced(spark, tmp_path, monkeypatch):
    warehouse = str(tmp_path)
    records = records_from_python(spark, [{"k": 1, "v": 1}, {"k": 2, "v": 2}])
    schema = infer_schema(records, SPEC)
    real = load.current_run
    calls = []

    def broken(*args):
        calls.append(args)
        if len(calls) == 2:  # all files are written, the commit is not
            raise RuntimeError("the driver is gone")
        return real(*args)

    monkeypatch.setattr(load, "current_run", broken)
    with pytest.raises(RuntimeError):
        load_job(spark, records, SPEC, schema, warehouse, run_id="one")
    monkeypatch.setattr(load, "current_run", real)
    assert read_table(spark, warehouse, "s", "t") is None
    done = load_job(spark, records, SPEC, schema, warehouse, run_id="one")
    assert load_job(spark, records, SPEC, schema, warehouse, run_id="one") == done and done.records_loaded == 2
    assert read_table(spark, warehouse, "s", "t").count() == 2
    assert [(r.run_id, r.status) for r in read_runs(spark, warehouse, "s").collect()] == [("one", "succeeded")]


def test_the_log_is_folded(spark, tmp_path):
    root, today = str(tmp_path), dt.datetime.now(dt.UTC).date()
    at = lambda n: dt.datetime.combine(today - dt.timedelta(days=n), dt.time(1), dt.UTC)

    def write(run, state, status, day, finished=None):
        record_run(spark, root, {"run_id": run, "consumer": "s", "job": "t", "status": status, "started_at": at(3), "finished_at": None if finished is None else at(finished),
                                 "records_loaded": 1}, state, today - dt.timedelta(days=day))

    write("a", 1, "running", 3), write("a", 2, "succeeded", 3, 3)
    write("b", 1, "running", 3), write("b", 2, "failed", 2, 2), write("b", 1, "running", 1), write("b", 2, "succeeded", 0, 0)
    write("c", 1, "running", 2)

    def seen():
        return sorted((r.run_id, r.status) for r in read_runs(spark, root, "s").collect())

    whole = [("a", "succeeded"), ("b", "succeeded"), ("c", "running")]
    assert seen() == whole
    for days in (2, 1, 1, 0):
        fold_runs(spark, root, "s", today - dt.timedelta(days=days))
        assert seen() == whole
    write("c", 2, "succeeded", 0, 0)
    assert seen() == [("a", "succeeded"), ("b", "succeeded"), ("c", "succeeded")]
    folded = spark.read.parquet(f"{root}/s/_runs_folded").where(F.col("through") == F.lit(today))
    assert folded.count() == 3 and "written" in read_runs(spark, root, "s")._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        fold_runs(spark, root, "s", today + dt.timedelta(days=1))


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    warehouse, path = str(tmp_path / "warehouse"), str(tmp_path / "batch")
    rows = spark.range(200_000, numPartitions=8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    rows.withColumn("_run_id", F.lit("r")).write.parquet(path)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        publish_batch(spark, spark.read.parquet(path), JobSpec("s", "big", ("id",)), warehouse, "r", ["id"], buckets=2)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes") if before is None else spark.conf.set(
            "spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = {b: len(list((tmp_path / "warehouse/s/big/data/__run=r" / f"__bucket={b}").glob("*.parquet"))) for b in (0, 1)}
    assert min(files.values()) > 1
    assert spark.read.parquet(f"{warehouse}/s/big/data").count() == 200_000


def test_buckets_follow_the_first_batch(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(str(tmp_path / "b"))
    batch = spark.read.parquet(str(tmp_path / "b"))
    assert load.buckets_for(batch) == load.BUCKETS
    monkeypatch.setattr(load, "BUCKET_BYTES", 100)
    n = load.buckets_for(batch)
    assert n > load.BUCKETS and n & (n - 1) == 0
