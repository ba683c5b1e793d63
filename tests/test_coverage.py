"""Saved watermarks (W4), insert-only upsert (K2), earthquake job options (G6) and
common order lines (N3) on literal cases and the smallest driver tables."""

from datetime import datetime

from pyspark.sql import functions as F

from ledgerflow.operators.load import upsert
from ledgerflow.operators.runs import RUNS_SCHEMA, last_watermark, saved_watermarks
from ledgerflow.suite import coverage_queries as cq

from helpers import frame

SF = "/root/testdata/sf0.001"


def _runs(spark, rows):
    full = [{**dict.fromkeys(RUNS_SCHEMA.fieldNames()), **r} for r in rows]
    return spark.createDataFrame([tuple(r[f] for f in RUNS_SCHEMA.fieldNames()) for r in full], RUNS_SCHEMA)


def test_watermark_ignores_failed_running_and_null_values(spark):
    t = lambda h: datetime(2024, 1, 1, h)
    runs = _runs(spark, [
        {"run_id": "a", "consumer": "c", "job": "j", "status": "succeeded", "started_at": t(1), "finished_at": t(2),
         "max_incremental_value": "2024-01-01T00:00:00"},
        {"run_id": "b", "consumer": "c", "job": "j", "status": "failed", "started_at": t(3), "finished_at": t(4),
         "max_incremental_value": "2024-06-01T00:00:00"},
        {"run_id": "c", "consumer": "c", "job": "j", "status": "running", "started_at": t(5)},
        {"run_id": "d", "consumer": "c", "job": "j", "status": "succeeded", "started_at": t(5), "finished_at": t(6)},
        {"run_id": "e", "consumer": "c", "job": "k", "status": "succeeded", "started_at": t(1), "finished_at": t(2),
         "max_incremental_value": "x1"},
        {"run_id": "f", "consumer": "c", "job": "k", "status": "succeeded", "started_at": t(1), "finished_at": t(2),
         "max_incremental_value": "x2"},
    ])
    got = {(r["job"], r["watermark"]) for r in saved_watermarks(runs).collect()}
    # job k: equal finish times, the larger run id wins (deterministic)
    assert got == {("j", "2024-01-01T00:00:00"), ("k", "x2")}
    assert last_watermark(runs, "c", "j").collect()[0]["watermark"] == "2024-01-01T00:00:00"
    assert last_watermark(runs, "c", "missing").collect() == []


def test_all_key_upsert_only_inserts(spark):
    cur = frame(spark, [{"a": 1, "b": "x"}, {"a": 2, "b": "y"}], "a int, b string")
    inc = frame(spark, [{"a": 1, "b": "x"}, {"a": 3, "b": "z"}], "a int, b string")
    got = sorted(tuple(r) for r in upsert(cur, inc, ["a", "b"], order_col=None).collect())
    assert got == [(1, "x"), (2, "y"), (3, "z")]


def test_earthquake_jobs_apply_their_options(spark):
    out = cq.q_earthquake_feed(spark, SF)
    quakes = out.filter(F.col("job") == "earthquakes")
    assert quakes.filter(F.col("mag") < 2.5).count() == 0
    sig = out.filter(F.col("job") == "significant_earthquakes")
    assert sig.filter((F.col("sig") < 600) | (F.col("time") < "2024-01-10")).count() == 0
    ev = spark.read.parquet(f"{SF}/events.parquet")
    assert quakes.count() == ev.filter(F.col("value") / 50 >= 2.5).count()
    row = quakes.orderBy("id").first()
    assert row["time"].endswith("+00:00") and row["second_type"] == "phase-data"


def test_common_order_lines_keep_every_line(spark):
    out = cq.q_conform_order_lines(spark, SF)
    o = spark.read.parquet(f"{SF}/orders.parquet")
    shop = o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    expected_shop = shop.select(F.sum(F.lit(1) + F.col("o_orderkey") % 4)).first()[0]
    assert out.filter(F.col("source") == "shopfront").count() == expected_shop
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    cart_li = li.join(o.filter(~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")),
                      li.l_orderkey == o.o_orderkey, "inner")
    assert out.filter(F.col("source") == "cartwheel").count() == cart_li.count()
    # line numbers of embedded items start at 1
    assert out.filter((F.col("source") == "shopfront") & (F.col("line_number") < 1)).count() == 0


def test_orphan_count_with_hot_key_equals_failing_rows(spark):
    from ledgerflow.operators.quality import orphan_count, relationships

    # a third of the child rows share one orphan key; NULL keys pass; parents repeat
    child = spark.createDataFrame([(i, 999 if i % 3 == 0 else (None if i % 10 == 1 else i % 50)) for i in range(900)],
                                  "id int, fk int")
    parent = spark.createDataFrame([(k % 40,) for k in range(400)], "pk int")
    expected = relationships(child, "fk", parent, "pk").count()
    assert expected == orphan_count(child, "fk", parent, "pk").first()["failures"]
    assert expected == 300 + child.filter("fk >= 40 and fk < 50").count()


def test_contract_report_counts_values_that_do_not_cast(spark):
    from pyspark.sql import types as T

    from ledgerflow.operators.quality import contract_report

    df = spark.createDataFrame([("12", 1), ("abc", 2), (None, 3), ("7.5", 4)], "x string, y int")
    contract = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("z", T.DateType())])
    rows = {r["column"]: r.asDict() for r in contract_report(df, contract).collect()}
    assert rows["x"]["problem"] == "type mismatch" and rows["x"]["uncastable"] == 2  # 'abc' and '7.5'
    assert rows["z"]["problem"] == "missing" and rows["z"]["uncastable"] is None
    assert rows["y"]["problem"] == "not in contract"
    assert {r["rows_checked"] for r in rows.values()} == {4}


def test_upsert_matches_null_keys_and_replaces_whole_rows(spark):
    cur = frame(spark, [{"k": 1, "v": "a", "w": "x"}, {"k": None, "v": "b", "w": "y"}, {"k": 3, "v": "c", "w": "z"}],
                "k int, v string, w string")
    inc = frame(spark, [{"k": None, "v": "B"}, {"k": 3, "v": "C"}, {"k": 4, "v": "D"}], "k int, v string")
    got = sorted(((r.k is None, r.k), r.v, r.w) for r in upsert(cur, inc, ["k"], order_col=None).collect())
    # the NULL key is one key (replaced, not duplicated); a column the batch lacks becomes NULL
    assert got == [((False, 1), "a", "x"), ((False, 3), "C", None), ((False, 4), "D", None), ((True, None), "B", None)]


def test_load_queries_see_changed_input(spark, tmp_path):
    """A second call in a session loads again: rows that came to the same path are in it."""
    events = spark.read.parquet(f"{SF}/events.parquet")
    pairs = events.select("user_id", "event_type").distinct().count()
    path = f"{tmp_path}/events.parquet"
    some = events.where("user_id % 2 = 0")
    some.write.parquet(path)
    few = cq.q_incremental_load_table(spark, str(tmp_path)).count()
    read = max(r["records_loaded"] or 0 for r in cq.q_incremental_load_runs(spark, str(tmp_path)).collect())
    events.where("user_id % 2 <> 0 or user_id is null").write.mode("append").parquet(path)
    assert few < pairs == cq.q_incremental_load_table(spark, str(tmp_path)).count()
    assert read < max(r["records_loaded"] or 0 for r in cq.q_incremental_load_runs(spark, str(tmp_path)).collect())
