"""Loads into a bucketed table: keys, strictness, resumption, touched buckets."""

import json
import os
import tempfile
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import load
from ledgerflow.operators.infer import infer_schema
from ledgerflow.operators.load import LoadError, load_job, next_bound, read_runs, read_table, rejected_records
from ledgerflow.sources.records import read_json_lines, records_from_python
from ledgerflow.spec import IncrementalSpec, JobSpec

FORMAT = "%d/%m/%Y %H:%M"
STOCK = JobSpec("depot", "stock", ("site", "part"), IncrementalSpec("counted", "01/03/2022 00:00", FORMAT))


def fresh():
    return tempfile.mkdtemp(prefix="depot-", dir="/tmp")


def counts(*rows):
    return [{"site": s, "part": p, "units": u, "counted": c, "bin": {"row": u % 3}} for s, p, u, c in rows]


FIRST = counts(("north", 10, 5, "02/03/2022 08:00"), ("north", 11, 8, "03/03/2022 09:00"),
               ("south", 10, 2, "03/03/2022 09:30"), ("north", 10, 6, "04/03/2022 07:15"))


@pytest.fixture(scope="module")
def schema(spark):
    return infer_schema(records_from_python(spark, FIRST), STOCK, checkpoint=False)


def run(spark, rows, schema, root, **kw):
    return load_job(spark, records_from_python(spark, rows), STOCK, schema, root, buckets=4, **kw)


def table(spark, root, spec=STOCK):
    return {tuple(r[k] for k in spec.primary_keys): r for r in read_table(spark, root, spec.consumer, spec.name).collect()}


def test_first_load(spark, schema):
    root = fresh()
    result = run(spark, FIRST, schema, root)
    rows = table(spark, root)
    assert {k: r["units"] for k, r in rows.items()} == {("north", 10): 6, ("north", 11): 8, ("south", 10): 2}
    assert rows["north", 11]["counted"] == datetime(2022, 3, 3, 9, 0) and {r["_run_id"] for r in rows.values()} == {result.run_id}
    assert (result.records_loaded, result.max_incremental_value) == (4, "04/03/2022 07:15")
    log = read_runs(spark, root, "depot").collect()
    assert [(r["status"], r["records_loaded"], r["lower_bound"], r["error"]) for r in log] == [("succeeded", 4, "01/03/2022 00:00", None)]


def test_later_runs_rewrite_touched_buckets_only(spark, schema):
    root = fresh()
    run(spark, FIRST, schema, root, run_id="a")
    before = load.bucket_runs(spark, root, "depot", "stock", "a")
    touched = run(spark, counts(("south", 10, 9, "06/03/2022 10:00")), schema, root, run_id="b")
    after = load.bucket_runs(spark, root, "depot", "stock", "b")
    changed = {b for b in after if after[b] != before[b]}
    assert len(changed) == 1 and after[changed.pop()] == "b" and touched.records_loaded == 1
    assert len([d for d in os.listdir(f"{root}/depot/stock/data/__run=b") if d.startswith("__bucket=")]) == 1
    assert table(spark, root)["south", 10]["units"] == 9 and len(table(spark, root)) == 3
    # nothing at or after the watermark: no files, the table stays
    run(spark, FIRST[:1], schema, root, run_id="c")
    assert not os.path.exists(f"{root}/depot/stock/data/__run=c") and load.current_run(spark, root, "depot", "stock") == "b"


def test_the_batch_is_computed_once(spark, schema):
    seen = spark.sparkContext.accumulator(0)

    def counted(rows):
        for r in rows:
            seen.add(1)
            yield r

    source = spark.createDataFrame(spark.sparkContext.parallelize([(n, json.dumps(r)) for n, r in enumerate(FIRST)], 2).mapPartitions(counted), "ordinal long, text string")
    root = fresh()
    load_job(spark, source.select("ordinal", F.parse_json("text").alias("record")), STOCK, schema, root, buckets=2)
    assert seen.value == len(FIRST)


def test_resume_and_failure(spark, schema):
    root = fresh()
    run(spark, FIRST, schema, root)
    runs = read_runs(spark, root, "depot")
    assert next_bound(runs, STOCK) == datetime(2022, 3, 4, 7, 15, tzinfo=UTC)
    assert next_bound(runs, STOCK, full_refresh=True) == STOCK.incremental.start
    late = JobSpec("depot", "stock", STOCK.primary_keys, IncrementalSpec("counted", "01/03/2022 00:00", FORMAT, 7200))
    assert next_bound(runs, late) == datetime(2022, 3, 4, 5, 15, tzinfo=UTC)
    long_ago = JobSpec("depot", "stock", STOCK.primary_keys, IncrementalSpec("counted", "01/03/2022 00:00", FORMAT, 10**8))
    assert next_bound(runs, long_ago) == STOCK.incremental.start
    with pytest.raises(Exception, match="schema does not have: colour"):
        run(spark, [*FIRST, {**FIRST[0], "colour": "red", "counted": "09/03/2022 00:00"}], schema, root, run_id="bad")
    failed = read_runs(spark, root, "depot").where("run_id = 'bad'").first()
    assert failed["status"] == "failed" and "colour" in failed["error"] and failed["max_incremental_value"] is None
    assert next_bound(read_runs(spark, root, "depot"), STOCK) == datetime(2022, 3, 4, 7, 15, tzinfo=UTC)
    again = run(spark, [*FIRST, *counts(("west", 1, 1, "05/03/2022 00:00"))], schema, root)
    assert again.records_loaded == 2  # the row at the bound is read again
    assert table(spark, root)["north", 11]["units"] == 8 and ("west", 1) in table(spark, root)


@pytest.mark.parametrize("change, reason", [
    ({"site": None}, "key field 'site' is null or missing"),
    ({"units": 5.5}, "field 'units' is not integer but number"),
    ({"units": "7"}, "field 'units' is not integer but string"),
    ({"units": True}, "field 'units' is not integer but boolean"),
    ({"bin": [1]}, "field 'bin' is not object but array"),
    ({"counted": "2022"}, "field 'counted' is not a date-time: 2022"),
    ({"counted": 5}, "field 'counted' is not date-time but integer"),
    ({"extra": 1, "more": 2}, "fields that the schema does not have: extra, more"),
])
def test_rejected_records(spark, schema, change, reason):
    records = records_from_python(spark, [FIRST[0], {**FIRST[1], **change}])
    got = rejected_records(records, schema, STOCK).collect()
    assert [(r["ordinal"], r["reasons"]) for r in got] == [(2, [reason])]
    with pytest.raises(Exception) as error:
        load.prepare(records, schema, STOCK, "r", datetime.now(UTC)).collect()
    assert f"record 2: {reason}" in str(error.value)


def test_dates_are_strict(spark):
    spec = JobSpec("depot", "days", ("k",))
    schema = infer_schema(records_from_python(spark, [{"k": 1, "d": "2022-01-05", "t": "2022-01-05T10:00:00+01:00"}]), spec, checkpoint=False)
    bad = [{"k": n, "d": d, "t": t} for n, (d, t) in enumerate([("2022-1-5", None), ("2022-01-05T23:10:00", None), ("2022-02-30", None), (None, "2022"),
                                                                (None, "2022-01-05 10:00 Europe/Rome"), ("2022-01-06", "2022-01-06")])]
    got = rejected_records(records_from_python(spark, bad), schema, spec).collect()
    assert sorted(r["ordinal"] for r in got) == [1, 2, 3, 4, 5]


def test_any_field_name_loads(spark):
    spec = JobSpec("depot", "names", ("it's",))
    rows = [{"it's": 1, "Name": "a", "name": "b", "x.y": 2, "sp ace": True, "`q`": "t", "bucket": 5, "run": "r", "ordinal": 9}]
    schema = infer_schema(records_from_python(spark, rows), spec, checkpoint=False)
    root = fresh()
    for value in ("b", "c"):
        rows[0]["name"] = value
        load_job(spark, records_from_python(spark, rows), spec, schema, root, buckets=2)
    row = read_table(spark, root, "depot", "names").first().asDict()
    assert {k: row[k] for k in ("it's", "Name", "name__2", "x.y", "sp ace", "`q`", "bucket", "run", "ordinal__2")} == {
        "it's": 1, "Name": "a", "name__2": "c", "x.y": 2, "sp ace": True, "`q`": "t", "bucket": 5, "run": "r", "ordinal__2": 9}


def test_new_columns_are_null_in_old_rows(spark):
    spec = JobSpec("depot", "grow", ("k",))
    root = fresh()
    for rows in ([{"k": k} for k in range(6)], [{"k": 3, "colour": "red"}]):
        schema = infer_schema(records_from_python(spark, rows), spec, checkpoint=False)
        load_job(spark, records_from_python(spark, rows), spec, schema, root, buckets=3)
    assert {k[0]: r["colour"] for k, r in table(spark, root, spec).items()} == {0: None, 1: None, 2: None, 3: "red", 4: None, 5: None}


def test_unix_seconds(spark):
    spec = JobSpec("depot", "pings", ("k",), IncrementalSpec("s", "1600000000", "epoch"))
    rows = [{"k": 1, "s": 1600000100}, {"k": 2, "s": 1599999999}, {"k": 3, "s": 1600000200}]
    schema = infer_schema(records_from_python(spark, rows), spec, checkpoint=False)
    root = fresh()
    first = load_job(spark, records_from_python(spark, rows), spec, schema, root, buckets=2)
    assert (first.records_loaded, first.max_incremental_value) == (2, "1600000200")
    assert load_job(spark, records_from_python(spark, rows), spec, schema, root, buckets=2).records_loaded == 1


def test_look_back_catches_rows_that_appear_late(spark):
    # r was changed before the watermark but became visible after the first run
    spec = lambda s: JobSpec("depot", "moves", ("id",), IncrementalSpec("when", "2022-05-01T00:00:00+0000", "%Y-%m-%dT%H:%M:%S%z", s))
    q, r = {"id": "q", "when": "2022-05-02T06:00:00+02:00"}, {"id": "r", "when": "2022-05-02T03:50:00+00:00"}
    for seconds, seen in ((0, {"q"}), (900, {"q", "r"})):
        schema, root = infer_schema(records_from_python(spark, [q, r]), spec(seconds), checkpoint=False), fresh()
        for rows in ([q], [q, r]):
            load_job(spark, records_from_python(spark, rows), spec(seconds), schema, root, buckets=2)
        assert {k for (k,) in table(spark, root, spec(seconds))} == seen


def test_upsert_replaces_whole_rows_and_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (None, "n", 2.0), (3, "c", 3.0)], "k int, v string, w double")
    new = spark.createDataFrame([(1, None), (None, "m"), (4, "d")], "k int, v string")
    once = load.upsert(old, new, ["k"], order_col=None)
    rows = {(r["k"], r["v"], r["w"]) for r in once.collect()}
    assert rows == {(1, None, None), (None, "m", None), (3, "c", 3.0), (4, "d", None)}
    assert {tuple(r) for r in load.upsert(once, new, ["k"], order_col=None).collect()} == {(k, v, w) for k, v, w in rows}
    keys = load.upsert(old.select("k"), new.select("k"), ["k"], order_col=None)
    assert sorted(str(r["k"]) for r in keys.collect()) == ["1", "3", "4", "None"]


def test_last_write_needs_a_place(spark):
    rows = spark.createDataFrame([(1, "a", 5), (1, "b", 7), (1, "c", 6)], "k int, v string, ordinal long")
    assert load.dedupe_last(rows, ["k"]).first()["v"] == "b"
    with pytest.raises(Exception, match="cannot be ordered"):
        load.dedupe_last(rows.withColumn("ordinal", F.lit(None).cast("long")), ["k"]).collect()


def test_keys_of_job_and_schema_must_agree(spark, schema):
    with pytest.raises(LoadError, match="keyed by part but its schema was inferred for site, part"):
        load_job(spark, records_from_python(spark, FIRST), JobSpec("depot", "stock", ("part",), STOCK.incremental), schema, fresh())


def _land(root, day, page, rows):
    os.makedirs(f"{root}/dt={day}", exist_ok=True)
    with open(f"{root}/dt={day}/page-{page:06d}.jsonl", "w") as fh:
        fh.writelines(json.dumps(r) + "\n" for r in rows)


def test_later_days_win_over_later_pages(spark, schema):
    landing, root = fresh(), fresh()
    _land(landing, "2022-03-05", 9, counts(("north", 10, 1, "05/03/2022 01:00")))
    _land(landing, "2022-03-06", 1, counts(("north", 10, 2, "05/03/2022 01:00")))
    records = read_json_lines(spark, landing, landed_on="dt")
    load_job(spark, records, STOCK, schema, root, buckets=2)
    assert table(spark, root)["north", 10]["units"] == 2


def test_load_reads_only_the_days_that_matter(spark, schema):
    landing, root = fresh(), fresh()
    _land(landing, "2022-03-05", 1, counts(("north", 10, 1, "05/03/2022 01:00")))
    plans = []

    def source(since: date | None):
        records = read_json_lines(spark, landing, landed_on="dt", landed_since=since)
        plans.append(records._jdf.queryExecution().executedPlan().toString())
        return records

    load_job(spark, source, STOCK, schema, root, buckets=2)
    _land(landing, "2022-03-07", 1, counts(("north", 10, 4, "06/03/2022 01:00")))
    assert load_job(spark, source, STOCK, schema, root, buckets=2).records_loaded == 2
    assert "2022-03-01" in plans[0] and all("PartitionFilters: [isnotnull(dt" in p for p in plans) and "2022-03-05" in plans[1]


def test_pages_of_any_size_keep_their_order(spark, tmp_path):
    big = (1 << 20) + 3
    os.makedirs(tmp_path / "p")
    for page, n in ((1, big), (2, 3)):
        with open(tmp_path / "p" / f"x-{page}.jsonl", "w") as fh:
            fh.writelines(f'{{"k":1,"v":"{page}-{i}"}}\n' for i in range(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        records = read_json_lines(spark, str(tmp_path / "p"))
        assert records.rdd.getNumPartitions() > 4  # a page is split
        assert records.select("ordinal").distinct().count() == big + 3
        last = load.dedupe_last(records.select(F.variant_get("record", "$.v", "string").alias("v"), F.col("ordinal.page").alias("page"), "ordinal"), ["page"])
        assert {r["page"]: r["v"] for r in last.collect()} == {1: f"1-{big - 1}", 2: "2-2"}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_file_without_a_page_fails(spark, tmp_path):
    (tmp_path / "orders.json").write_text('{"k": 1}\n')
    with pytest.raises(Exception, match="no page number in the landed file name"):
        read_json_lines(spark, str(tmp_path)).collect()
