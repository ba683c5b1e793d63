"""The landed-pages data source: cutting arrays, planning by day, batch and stream."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerflow.sources import plugin
from ledgerflow.sources.vendors import load_pages, stream_pages
from ledgerflow.spec import JobSpec

ITEMS = JobSpec("netsuite", "items", ("id",))
VALUES = [{"id": 1, "t": 'a "quoted" \\ [x], {y}'}, {"id": 2, "n": [[], [1, {"items": [9]}]]}, 3, "text, ] }", None, [], True, {}, "é \\"]


def cut(key, text, size):
    cutter, out = plugin.ArrayCutter(key), []
    for at in range(0, len(text), size):
        out += [json.loads(x) for x in cutter.feed(text[at:at + size])]
    cutter.close()
    return out


@pytest.mark.parametrize("size", [1, 2, 3, 7, 10_000])
def test_arrays_are_cut_whatever_the_pieces(size):
    page = {"a": [1, {"items": [0]}], "s": "items", "items2": {"items": [5]}, "items": VALUES, "links": ["items", [1]], "hasMore": False}
    for indent in (None, 2):
        for raw in (False, True):
            assert cut("items", json.dumps(page, indent=indent, ensure_ascii=raw), size) == VALUES
            assert cut(None, json.dumps(VALUES, indent=indent, ensure_ascii=raw), size) == VALUES
    assert cut("it\"s", json.dumps({"it\"s": [1, 2]}), size) == [1, 2]
    for empty in ({"items": []}, {"other": [1]}, {"items": None}, {}):
        assert cut("items", json.dumps(empty), size) == []


@pytest.mark.parametrize("key, text", [("items", "[1]"), ("items", '{"items": {"a": 1}}'), (None, '{"a": 1}'), ("items", '{"items": [1, 2'),
                                       ("items", '{"items": ["x'), ("items", "")])
def test_broken_pages_fail(key, text):
    with pytest.raises(plugin.PageError):
        cut(key, text, 4)


def test_a_page_holds_one_element_at_a_time():
    cutter, most, n = plugin.ArrayCutter("items"), 0, 0
    for _ in cutter.feed('{"total": 9, "items": ['):
        pass
    for i in range(20_000):
        n += sum(1 for _ in cutter.feed(json.dumps({"id": i, "pad": "x" * 50}) + ", "))
        most = max(most, len(cutter.text))
    assert n == 20_000 and most < 200


def land(folder, pages, job="items"):
    for day, page, rows in pages:
        path = folder / job / f"day={day}"
        path.mkdir(parents=True, exist_ok=True)
        (path / f"part-{page}.json").write_text(json.dumps({"items": rows, "count": len(rows)}))


def test_days_prune_while_partitions_are_planned(spark, tmp_path):
    land(tmp_path, [(f"2024-01-0{d}", d, [{"id": d, "links": ["x"]}, {"id": 10 + d}]) for d in (1, 2, 3, 4)])
    reader = plugin.PagesReader({"path": str(tmp_path / "items"), "landed_on": "day", "partition_bytes": "1"})
    import datetime as dt

    left = reader.pushFilters([plugin.GreaterThan(("landed",), dt.date(2024, 1, 1)), plugin.LessThanOrEqual(("landed",), dt.date(2024, 1, 3)),
                               plugin.EqualTo(("page",), 2)])
    assert [type(f).__name__ for f in left] == ["GreaterThan", "EqualTo"]
    assert [p.landed.day for g in reader.partitions() for p in g.pages] == [1, 2, 3]
    (tmp_path / "items" / "day=2024-01-01" / "part-1.json").write_text("not a page")  # must not be read
    plugin.register(spark)
    rows = spark.read.format(plugin.FORMAT).options(path=str(tmp_path / "items"), envelope="items", landed_on="day").load()
    got = rows.where("landed >= date'2024-01-02'").orderBy("landed", "pos").collect()
    assert [(r["landed"].day, r["page"], r["pos"], json.loads(r["record"])["id"]) for r in got] == [
        (d, d, p, d + 10 * p) for d in (2, 3, 4) for p in (0, 1)]


def test_records_keep_order_and_drop_keys(spark, tmp_path):
    land(tmp_path, [("2024-01-01", 1, [{"id": 5, "links": [1]}, {"id": 4}]), ("2024-01-02", 1, [{"id": 3}])])
    got = load_pages(spark, str(tmp_path), ITEMS, landed_on="day").orderBy("ordinal").select(F.to_json("record")).collect()
    assert [r[0] for r in got] == ['{"id":5}', '{"id":4}', '{"id":3}']


def test_a_page_larger_than_any_share(spark, tmp_path):
    rng = random.Random(0)
    path = tmp_path / "items"
    path.mkdir()
    with open(path / "huge-7.json", "w") as f:
        f.write('{"items": [')
        for i in range(60_000):
            f.write(("," if i else "") + json.dumps({"id": i, "pad": "y" * rng.randint(0, 200)}))
        f.write("]}")
    got = load_pages(spark, str(tmp_path), ITEMS).agg(F.count("*"), F.sum(F.variant_get("record", "$.id", "long")), F.max("ordinal.pos")).first()
    assert tuple(got) == (60_000, 60_000 * 59_999 // 2, 59_999)


def test_stream_reads_each_page_once(spark, tmp_path):
    landing, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    land(landing, [("2024-01-01", n, [{"id": n}]) for n in (1, 2, 3)])

    def run():
        ids = stream_pages(spark, str(landing), ITEMS, files_per_batch="2").select(F.variant_get("record", "$.id", "long").alias("id"))
        query = ids.writeStream.option("checkpointLocation", state).trigger(processingTime="0 seconds").format("parquet").start(out)
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return sorted(r["id"] for r in spark.read.parquet(out).collect())

    assert run() == [1, 2, 3]
    land(landing, [("2024-01-02", n, [{"id": n}]) for n in (4, 5)])
    assert run() == [1, 2, 3, 4, 5]  # a restarted query goes on behind its checkpoint
