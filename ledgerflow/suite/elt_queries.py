"""Registered queries for the extract-load operators, over the driver tables.

Records are derived from whole tables (events, orders) by fixed rules mirrored in the
oracle SQL; every query runs the library operator on all of them.
"""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators import conform, quality
from ledgerflow.operators.infer import (
    InferredSchema,
    PathType,
    conflict_report,
    conflicts,
    infer_schema,
    merge_observations,
    merge_schemas,
    observe_records,
    path_text,
    resolved_table,
    schema_table,
)
from ledgerflow.operators.load import (
    dedupe_last,
    incremental_filter,
    read_table,
    next_bound,
    unknown_fields,
    upsert,
)
from ledgerflow.operators.runs import RUNS_SCHEMA, append_snapshot, latest_snapshot, read_snapshot
from ledgerflow.functions.scalars import format_instant, split_nonempty
from ledgerflow.plans import contracts, reporting
from ledgerflow.plans.standins import StandIns
from ledgerflow.session import scratch_path, spread_skinny
from ledgerflow.sources.catalog import read_schema, update_schema
from ledgerflow.sources.landed import Landed, land
from ledgerflow.sources.records import unnest_pages
from ledgerflow.spec import IncrementalSpec, JobSpec
from ledgerflow.streaming.upsert import stream_upsert

SPLIT_TS = "2024-01-15 00:00:00"


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def _json(*cols: Column) -> Column:
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def _records(df: DataFrame, text: Column, ordinal: Column) -> DataFrame:
    # spread before the text is made and parsed, which is the heavy part
    return spread_skinny(df).select(ordinal.cast("long").alias("ordinal"), F.parse_json(text).alias("record"))


# --- inference ------------------------------------------------------------------------

def events_props_records(spark: SparkSession, sf: str) -> DataFrame:
    ev = _t(spark, sf, "events")
    text = _json(
        F.col("event_id").alias("id"),
        _iso(F.col("ts")).alias("at"),
        F.col("user_id"),
        F.col("event_type"),
        F.col("value"),
        F.from_json("props", "k bigint").alias("props"),
    )
    return _records(ev, text, F.col("event_id"))


def mixed_records(spark: SparkSession, sf: str) -> DataFrame:
    ev = _t(spark, sf, "events")
    et = F.col("event_type")
    amount = F.when(et == "purchase", F.col("value")).when(et == "view", F.round("value").cast("bigint"))
    when = F.when(et == "signup", F.date_format("ts", "yyyy-MM-dd")).otherwise(_iso(F.col("ts")))
    tags = F.when(et == "error", F.array().cast("array<string>")).otherwise(F.array(et))
    meta = F.when(et != "error", F.from_json("props", "k bigint"))
    base = [F.col("event_id").alias("id"), amount.alias("amount"), when.alias("when"), tags.alias("tags"),
            meta.alias("meta")]
    text = F.when(et == "click", _json(*base, F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("label"))) \
        .otherwise(_json(*base))
    return _records(ev, text, F.col("event_id"))


def conflict_records(spark: SparkSession, sf: str) -> DataFrame:
    ev = _t(spark, sf, "events")
    et = F.col("event_type")
    x_int = _json(F.col("event_id").alias("id"), F.col("user_id").alias("x"), F.col("value").alias("y"))
    x_str = _json(F.col("event_id").alias("id"), et.alias("x"), F.col("value").alias("y"))
    y_bool = _json(F.col("event_id").alias("id"), F.col("user_id").alias("x"), (F.col("value") > 10).alias("y"))
    text = F.when(et == "error", x_str).when(et == "signup", y_bool).otherwise(x_int)
    return _records(ev, text, F.col("event_id"))


def q_infer_events_props(spark: SparkSession, sf: str) -> DataFrame:
    return schema_table(events_props_records(spark, sf), ("%Y-%m-%dT%H:%M:%S",))


def q_infer_mixed(spark: SparkSession, sf: str) -> DataFrame:
    return schema_table(mixed_records(spark, sf))


def _conflict_rows(found: DataFrame) -> DataFrame:
    return found.select(
        F.regexp_replace(F.array_join("path", ""), r"^\.", "").alias("path"), "cls",
        F.col("n").cast("bigint").alias("n"), "first_ordinal", "conflict_at")


def q_infer_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Per path: each observed class with its first record, and the record at which the
    accumulated types first become incompatible (I8)."""
    return _conflict_rows(conflicts(conflict_records(spark, sf)))


def _thirds(records: DataFrame) -> list[DataFrame]:
    """Three landings of the records."""
    return [records.where(F.pmod("ordinal", F.lit(3)) == n) for n in range(3)]


def q_merged_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Landings observed one by one, their statistics merged: the schema of all records."""
    parts = [observe_records(r) for r in _thirds(mixed_records(spark, sf))]
    return resolved_table(merge_observations(parts[2], parts[0], parts[1]))


def q_merged_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Conflicts between landings, with the first record of all that conflicts."""
    parts = [observe_records(r) for r in _thirds(conflict_records(spark, sf))]
    return _conflict_rows(conflict_report(merge_observations(*parts)))


MIXED_SPEC = JobSpec("events", "mixed", ("id",))


def _schema_rows(spark: SparkSession, schema: InferredSchema) -> DataFrame:
    rows = [(path_text(p.path), p.type, p.format, p.nullable, schema.records_scanned) for p in schema.paths]
    return spark.createDataFrame(rows, "path string, type string, format string, nullable boolean, records long")


def q_schema_by_landing(spark: SparkSession, sf: str) -> DataFrame:
    """The saved schema after three landings, one of them observed again, each
    reading only its own records."""
    root = scratch_path(spark, "schemas")
    landings = _thirds(mixed_records(spark, sf))
    for day in (0, 1, 2, 1):
        update_schema(spark, landings[day], MIXED_SPEC, root, f"day{day}")
    return _schema_rows(spark, read_schema(spark, root, MIXED_SPEC.consumer, MIXED_SPEC.name))


def q_merged_schema_documents(spark: SparkSession, sf: str) -> DataFrame:
    """2.16: two schema documents merged into the document of all records."""
    first, *rest = (infer_schema(r, MIXED_SPEC) for r in _thirds(mixed_records(spark, sf)))
    for schema in rest:
        first = merge_schemas(first, schema)
    return _schema_rows(spark, first)


# --- upserts --------------------------------------------------------------------------

def _event_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "events").select("user_id", "event_type", "event_id", "value", "ts")


def q_upsert_last_write(spark: SparkSession, sf: str) -> DataFrame:
    """Table of the last event per (user, type); first half loaded, then the
    second half upserted on top."""
    ev = _event_rows(spark, sf)
    split = F.lit(SPLIT_TS).cast("timestamp_ntz")
    pks = ["user_id", "event_type"]
    first = dedupe_last(ev.filter(F.col("ts") < split).drop("ts"), pks, "event_id")
    second = ev.filter(F.col("ts") >= split).drop("ts").withColumn("ordinal", F.col("event_id"))
    table = upsert(first, dedupe_last(second, pks, "ordinal"), pks)
    return table.select("user_id", "event_type", "event_id", "value")


def q_tombstone_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Per user, error events of the second half are tombstones; the upserted row
    keeps only the key and the deleted flag."""
    ev = _event_rows(spark, sf)
    split = F.lit(SPLIT_TS).cast("timestamp_ntz")
    cur = dedupe_last(ev.filter(F.col("ts") < split).drop("ts"), ["user_id"], "event_id").withColumn(
        "deleted", F.lit(False)
    )
    tomb = F.col("event_type") == "error"
    inc = ev.filter(F.col("ts") >= split).select(
        "user_id",
        F.when(~tomb, F.col("event_type")).alias("event_type"),
        F.when(~tomb, F.col("event_id")).alias("event_id"),
        F.when(~tomb, F.col("value")).alias("value"),
        tomb.alias("deleted"),
        F.col("event_id").alias("ordinal"),
    )
    table = upsert(cur, dedupe_last(inc, ["user_id"], "ordinal"), ["user_id"])
    return table.select("user_id", "event_type", "event_id", "value", "deleted")


def _runs(spark: SparkSession, rows: list[dict]) -> DataFrame:
    full = [{f.name: r.get(f.name) for f in RUNS_SCHEMA.fields} for r in rows]
    return F.broadcast(spark.createDataFrame(full, RUNS_SCHEMA))


def q_snapshot_latest_run(spark: SparkSession, sf: str) -> DataFrame:
    """Two full-refresh runs stamped the orders table; the latest succeeded one
    did not re-stamp orders in status P (deleted upstream); a later failed run is
    ignored."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    raw = o.withColumn("_run_id", F.lit("run-1")).unionByName(
        o.filter(F.col("o_orderstatus") != "P").withColumn("_run_id", F.lit("run-2"))
    )
    d = lambda day: datetime(2024, 1, day, tzinfo=UTC)
    runs = _runs(spark, [
        dict(run_id="run-1", consumer="erp", job="orders", status="succeeded", started_at=d(1), finished_at=d(1)),
        dict(run_id="run-2", consumer="erp", job="orders", status="succeeded", started_at=d(2), finished_at=d(2)),
        dict(run_id="run-3", consumer="erp", job="orders", status="failed", started_at=d(3), finished_at=d(3)),
    ])
    return latest_snapshot(raw, runs, "orders").select("o_orderkey", "o_orderstatus", "_run_id")


def q_snapshot_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """The same from a table laid out by run; a failed run's rows are there too."""
    o, path = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), scratch_path(spark, "snapshots")
    d = lambda day: datetime(2024, 1, day, tzinfo=UTC)
    log = []
    for day, (status, rows) in enumerate([("succeeded", o), ("succeeded", o.filter("o_orderstatus <> 'P'")), ("failed", o.limit(5))], 1):
        append_snapshot(rows, path, f"run-{day}")
        log.append(dict(run_id=f"run-{day}", consumer="erp", job="orders", status=status, started_at=d(day), finished_at=d(day)))
    return read_snapshot(spark, path, _runs(spark, log), "orders").select("o_orderkey", "o_orderstatus", "_run_id")


ORDER_SPEC = JobSpec("erp", "orders", ("o_orderkey",), IncrementalSpec("o_orderdate", "1995-01-01 00:00:00", "%Y-%m-%d %H:%M:%S"))


def _order_records(spark: SparkSession, sf: str) -> DataFrame:
    o = _t(spark, sf, "orders")
    text = _json(F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"))
    return _records(o, text, F.col("o_orderkey"))


def _watermark_runs(spark: SparkSession, consumer: str, job: str, value: str) -> DataFrame:
    d = datetime(2024, 1, 1, tzinfo=UTC)
    return _runs(spark, [dict(run_id=str(uuid.uuid5(uuid.NAMESPACE_URL, value)), consumer=consumer, job=job,
                              status="succeeded", started_at=d, finished_at=d, max_incremental_value=value)])


def _selected(records: DataFrame) -> DataFrame:
    return records.select(
        F.variant_get("record", "$.o_orderkey", "bigint").alias("o_orderkey"),
        F.variant_get("record", "$.o_orderdate", "string").alias("o_orderdate"),
    )


def q_incremental_bound(spark: SparkSession, sf: str) -> DataFrame:
    """Resume from the saved watermark, inclusive bound."""
    runs = _watermark_runs(spark, "erp", "orders", "1998-06-30 00:00:00")
    bound = next_bound(runs, ORDER_SPEC)
    return _selected(incremental_filter(_order_records(spark, sf), ORDER_SPEC, bound))


def q_landed_bound(spark: SparkSession, sf: str) -> DataFrame:
    """the same bound below the JSON parse: orders in two landings, with a typed key."""
    records, path = _order_records(spark, sf), scratch_path(spark, "landed-orders")
    for half in (0, 1):
        land(records.where(F.pmod("ordinal", F.lit(2)) == half), ORDER_SPEC, path, f"half-{half}")
    bound = next_bound(_watermark_runs(spark, "erp", "orders", "1998-06-30 00:00:00"), ORDER_SPEC)
    return _selected(Landed(path).since(spark, ORDER_SPEC, bound))


def _event_offset_records(spark: SparkSession, sf: str) -> DataFrame:
    ev = _t(spark, sf, "events")
    local = F.from_utc_timestamp(F.col("ts").cast("timestamp"), "+02:00")
    text = _json(F.col("event_id"), F.concat(_iso(local), F.lit("+02:00")).alias("updated_at"))
    return _records(ev, text, F.col("event_id"))


def q_lookback_reload(spark: SparkSession, sf: str) -> DataFrame:
    """U4/F2: offset timestamps compared as instants; 1800 s re-read before the mark."""
    spec = JobSpec("helpline", "cases", ("event_id",),
                   IncrementalSpec("updated_at", "2024-01-01T00:00:00+0000", "%Y-%m-%dT%H:%M:%S%z", 1800))
    runs = _watermark_runs(spark, "helpline", "cases", "2024-01-20T12:00:00+0000")
    bound = next_bound(runs, spec)
    out = incremental_filter(_event_offset_records(spark, sf), spec, bound)
    return out.select(
        F.variant_get("record", "$.event_id", "bigint").alias("event_id"),
        F.variant_get("record", "$.updated_at", "string").alias("updated_at"),
    )


def q_exclusive_to_inclusive(spark: SparkSession, sf: str) -> DataFrame:
    """a '>'-only source asked for '> bound - 1s' returns the inclusive set at
    one-second resolution."""
    spec = JobSpec("ticketdesk", "tickets", ("event_id",), IncrementalSpec("modified_at", "2024-01-01 00:00:00", "%Y-%m-%d %H:%M:%S"))
    ev = _t(spark, sf, "events")
    recs = _records(ev, _json(F.col("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("modified_at")),
                    F.col("event_id"))
    bound = datetime(2024, 1, 20, 12, 0, 0, tzinfo=UTC)
    out = incremental_filter(recs, spec, bound, exclusive_source=True)
    return out.select(F.variant_get("record", "$.event_id", "bigint").alias("event_id"))


def q_epoch_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Instants to unix seconds and back, ISO with milliseconds, and the
    watermark rendered with a strptime job format."""
    ev = _t(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("t"))
    secs = F.unix_seconds("t")
    return ev.select(
        "event_id",
        secs.alias("epoch_seconds"),
        F.date_format(F.timestamp_seconds(secs), "yyyy-MM-dd HH:mm:ss").alias("roundtrip"),
        F.date_format(F.timestamp_millis(F.unix_millis("t")), "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("iso_millis"),
        format_instant(F.col("t"), "%Y-%m-%dT%H:%M:%S").alias("watermark"),
        format_instant(F.col("t"), "epoch").alias("epoch_text"),
    )


def q_unknown_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Record keys outside the schema, per record."""
    ev = _t(spark, sf, "events")
    et = F.col("event_type")
    base = [F.col("event_id"), F.col("user_id"), et, F.col("value")]
    text = (
        F.when(et == "click", _json(*base, F.lit("n").alias("note")))
        .when(et == "error", _json(*base, F.lit(1).alias("extra"), F.lit("x").alias("debug")))
        .otherwise(_json(*base))
    )
    recs = _records(ev, text, F.col("event_id"))
    # the job's saved schema: four typed top-level fields
    kinds = {"event_id": "integer", "user_id": "integer", "event_type": "string", "value": "number"}
    schema = InferredSchema("events", "events", ("event_id",), None, "", 0,
                            tuple(PathType((f".{k}",), t) for k, t in kinds.items()))
    return unknown_fields(recs, schema).select(
        F.col("ordinal").alias("event_id"), F.array_join("unknown", ",").alias("unknown")
    )


def q_envelope_unnest(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of at most 100 events (by id range) wrapped in a ``data``
    envelope with a per-row ``links`` key; unnest keeps page order and drops ``links``."""
    ev = _t(spark, sf, "events").withColumn("page", F.floor(F.col("event_id") / 100).cast("long"))
    item = F.struct(
        F.col("event_id"),
        F.col("event_type"),
        F.concat(F.lit(","), F.col("event_type"), F.lit(",,u"), F.col("user_id").cast("string"), F.lit(",")).alias("labels"),
        F.array(F.col("user_id")).alias("links"),
    )
    pages = ev.groupBy("page").agg(F.sort_array(F.collect_list(item)).alias("data"))
    docs = pages.select("page", F.parse_json(F.to_json(F.struct("data"))).alias("page_doc"))
    rows = unnest_pages(docs, "data", drop=["links"])
    labels = split_nonempty(F.variant_get("record", "$.labels", "string"), ",")
    return rows.select(
        "ordinal.page", "ordinal.pos",
        F.variant_get("record", "$.event_id", "bigint").alias("event_id"),
        F.element_at(labels, 1).alias("first_label"),
        F.size(labels).cast("int").alias("n_labels"),
        F.variant_get("record", "$.links", "string").isNull().alias("links_dropped"),
    )


# --- common models ----------------------------------------------------------------------

def _vendor_orders(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    o = _t(spark, sf, "orders")
    shop = o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    cart = o.filter(~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    status = F.create_map(*[F.lit(x) for x in ("F", "delivered", "O", "shipped", "P", "pending")])
    state = F.create_map(*[F.lit(x) for x in ("F", "COMPLETE", "O", "IN_TRANSIT", "P", "AWAITING_PAYMENT")])
    placed = F.col("o_orderdate").cast("timestamp")
    shopfront = shop.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        status[F.col("o_orderstatus")].alias("status"),
        F.lit("USD").alias("currency"),
        F.col("o_totalprice").alias("total"),
        placed.alias("placed_at"),
        placed.alias("updated_at"),
    )
    cartwheel = cart.select(
        F.col("o_orderkey").alias("orderId"),
        F.col("o_custkey").alias("customerId"),
        state[F.col("o_orderstatus")].alias("orderState"),
        F.lit("EUR").alias("currencyCode"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("totalCents"),
        F.unix_seconds(placed).alias("placed"),
        F.unix_seconds(placed).alias("modified"),
        (F.col("o_orderstatus") == "P").alias("isDeleted"),
    )
    return shopfront, cartwheel


def q_conform_orders(spark: SparkSession, sf: str) -> DataFrame:
    shopfront, cartwheel = _vendor_orders(spark, sf)
    out = conform.common_orders(shopfront, cartwheel)
    return out.withColumn("total", F.col("total").cast("double")).withColumn(
        "placed_at", F.date_format("placed_at", "yyyy-MM-dd HH:mm:ss")
    ).drop("updated_at")


def q_conform_tickets(spark: SparkSession, sf: str) -> DataFrame:
    ev = _t(spark, sf, "events")
    et = F.col("event_type")
    created = F.col("ts").cast("timestamp")
    desk = ev.filter(et.isin("view", "click")).select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("Ticket "), F.col("event_id").cast("string")).alias("subject"),
        F.when(et == "view", "open").otherwise("solved").alias("status"),
        F.when(F.col("value") > 100, "urgent").otherwise("normal").alias("priority"),
        F.parse_json(F.to_json(F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@x.io")).alias("email")))).alias("requester"),
        F.col("user_id").alias("assignee_id"),
        F.array(et).cast("variant").alias("tags"),
        F.col("value").alias("time_spent_hours"),
        created.alias("created_at"),
        created.alias("modified_at"),
    )
    help_ = ev.filter(~et.isin("view", "click")).select(
        F.col("event_id").cast("string").alias("case_number"),
        F.concat(F.lit("Case "), F.col("event_id").cast("string")).alias("title"),
        F.when(et == "signup", "on_hold").otherwise("new").alias("state"),
        F.when(F.col("value") > 100, "P1").otherwise("P3").alias("urgency"),
        F.parse_json(F.to_json(F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@x.io")).alias("email")))).alias("contact"),
        F.parse_json(F.to_json(F.struct(F.col("user_id").cast("string").alias("staff_id")))).alias("owner"),
        F.concat(et, F.lit(";;vip;")).alias("labels"),
        F.round(F.col("value") * 60).cast("bigint").alias("effort_minutes"),
        created.alias("opened_at"),
        created.alias("updated_at"),
        (et == "error").alias("deleted"),
    )
    out = conform.common_tickets(desk, help_)
    return out.select(
        "source", "ticket_id", "status", "priority", "requester_email", "assignee_id",
        F.array_join("tags", "|").alias("tags"), F.col("hours").cast("double").alias("hours"),
    )


# --- data quality -------------------------------------------------------------------------

def q_dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    return quality.unique(_t(spark, sf, "lineitem"), "l_orderkey").withColumn(
        "occurrences", F.col("occurrences").cast("bigint")
    )


def _dq_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "orders": _t(spark, sf, "orders"),
        "lineitem": _t(spark, sf, "lineitem"),
        "customer": _t(spark, sf, "customer"),
    }


def q_dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    checks = [quality.Check(f"not_null_{t}_{c}", t, "not_null", (c,)) for t, c in
              (("orders", "o_orderkey"), ("orders", "o_custkey"), ("lineitem", "l_orderkey"), ("customer", "c_name"))]
    return quality.run_checks(_dq_tables(spark, sf), checks)


def q_dq_accepted(spark: SparkSession, sf: str) -> DataFrame:
    checks = [
        quality.Check("accepted_orderstatus", "orders", "accepted_values", ("o_orderstatus",), {"values": ["F", "O"]}),
        quality.Check("accepted_segment", "customer", "accepted_values", ("c_mktsegment",),
                      {"values": ["BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD", "FURNITURE"]}, "warn"),
    ]
    return quality.run_checks(_dq_tables(spark, sf), checks)


def q_dq_relationships(spark: SparkSession, sf: str) -> DataFrame:
    checks = [
        quality.Check("customer_has_orders", "customer", "relationships", ("c_custkey",),
                      {"to": "orders", "field": "o_custkey"}, "warn"),
        quality.Check("orders_to_customer", "orders", "relationships", ("o_custkey",),
                      {"to": "customer", "field": "c_custkey"}),
    ]
    return quality.run_checks(_dq_tables(spark, sf), checks)


def q_dq_unique_combo(spark: SparkSession, sf: str) -> DataFrame:
    return quality.unique_combination(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]).withColumn(
        "occurrences", F.col("occurrences").cast("bigint")
    )


def q_dq_freshness(spark: SparkSession, sf: str) -> DataFrame:
    now = datetime(2024, 2, 1, tzinfo=UTC)
    out = quality.freshness(_t(spark, sf, "events"), "ts", now, 36)
    return out.select(F.date_format("latest_loaded_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("latest_loaded_at"),
                      "age_hours", "is_stale")


def q_contract_report(spark: SparkSession, sf: str) -> DataFrame:
    s = StandIns(spark, sf)
    published = reporting.publish("fct_time_entries", s.categorized)
    from pyspark.sql import types as T

    contract = T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in
                             contracts.CONTRACTS["fct_time_entries"]])
    quality.assert_contract(published, contract)
    return quality.contract_report(published, contract)


def q_stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The events land as JSON-lines pages; a Structured Streaming query upserts
    them by (user, type) into a versioned table; the result equals the batch upsert."""
    ev = _event_rows(spark, sf).withColumn("page", F.floor(F.col("event_id") / 1000).cast("long"))
    landing = scratch_path(spark, "landing")
    warehouse = scratch_path(spark, "warehouse")
    line = F.to_json(F.struct("user_id", "event_type", "event_id", "value"))
    (ev.select("page", "event_id", line.alias("value"))
       .repartition("page").sortWithinPartitions("event_id").drop("event_id")
       .write.partitionBy("page").text(landing))
    spec = JobSpec("stream", "events", ("user_id", "event_type"))
    sample = _records(ev, line, F.col("event_id"))
    schema = infer_schema(sample, spec)
    q = stream_upsert(spark, landing, spec, schema, warehouse, checkpoint=scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    table = read_table(spark, warehouse, "stream", "events")
    return table.select("user_id", "event_type", "event_id", "value")


def queries() -> dict:
    return {
        "infer_events_props": q_infer_events_props,
        "infer_mixed": q_infer_mixed,
        "infer_conflicts": q_infer_conflicts,
        "merged_schema": q_merged_schema,
        "merged_conflicts": q_merged_conflicts,
        "schema_by_landing": q_schema_by_landing,
        "merged_schema_documents": q_merged_schema_documents,
        "upsert_last_write": q_upsert_last_write,
        "tombstone_upsert": q_tombstone_upsert,
        "snapshot_latest_run": q_snapshot_latest_run,
        "incremental_bound": q_incremental_bound,
        "landed_bound": q_landed_bound,
        "snapshot_partitioned": q_snapshot_partitioned,
        "lookback_reload": q_lookback_reload,
        "exclusive_to_inclusive": q_exclusive_to_inclusive,
        "epoch_roundtrip": q_epoch_roundtrip,
        "unknown_fields": q_unknown_fields,
        "envelope_unnest": q_envelope_unnest,
        "conform_orders": q_conform_orders,
        "conform_tickets": q_conform_tickets,
        "dq_unique": q_dq_unique,
        "dq_not_null": q_dq_not_null,
        "dq_accepted": q_dq_accepted,
        "dq_relationships": q_dq_relationships,
        "dq_unique_combo": q_dq_unique_combo,
        "dq_freshness": q_dq_freshness,
        "contract_report": q_contract_report,
        "stream_upsert": q_stream_upsert,
        "conform_customers": q_conform_customers,
        "conform_agents": q_conform_agents,
        "uncategorized_items": q_uncategorized_items,
        "top_client_hours_chart": q_top_client_hours_chart,
        "employee_dimension": q_employee_dimension,
        "schema_drift": q_schema_drift,
    }


# --- more common models, checks and report pieces ------------------------------------------

def q_conform_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of segments BUILDING/FURNITURE arrive in the storefront shape
    (nested address, single name), the others in the cart shape (flat columns, first and
    last name, Y/N consent, '' for missing tier, epoch seconds)."""
    c = _t(spark, sf, "customer")
    shop_seg = F.col("c_mktsegment").isin("BUILDING", "FURNITURE")
    created = F.lit("2024-01-01 00:00:00").cast("timestamp")
    shop = c.filter(shop_seg).select(
        F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("id"),
        F.concat(F.lower(F.col("c_name")), F.lit("@x.io")).alias("email"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") > 5000, "pro").alias("tier"),
        (F.col("c_acctbal") > 0).alias("marketing_opt_in"),
        F.parse_json(F.to_json(F.struct(F.concat(F.lit("City "), F.col("c_nationkey").cast("string")).alias("city"),
                                        F.lit("NO").alias("country")))).alias("address"),
        created.alias("created_at"),
        created.alias("updated_at"),
    )
    cart = c.filter(~shop_seg).select(
        F.col("c_custkey").alias("customerId"),
        F.split("c_name", "#").getItem(0).alias("firstName"),
        F.split("c_name", "#").getItem(1).alias("lastName"),
        F.concat(F.lower(F.col("c_name")), F.lit("@x.io")).alias("emailAddress"),
        F.when(F.col("c_acctbal") > 5000, "GOLD").otherwise("").alias("loyaltyTier"),
        F.when(F.col("c_acctbal") > 0, "Y").otherwise("N").alias("marketingConsent"),
        F.when(F.col("c_nationkey") < 12, F.concat(F.lit("City "), F.col("c_nationkey").cast("string"))).otherwise("").alias("addrCity"),
        F.lit("DE").alias("addrCountry"),
        F.unix_seconds(created).alias("created"),
        F.unix_seconds(created).alias("modified"),
        (F.col("c_acctbal") < 0).alias("isDeleted"),
    )
    out = conform.common_customers(shop, cart)
    return out.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")).drop("updated_at")


def q_conform_agents(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers of nations 0-11 are desk agents (boolean active), the others
    helpline staff (status word)."""
    s = _t(spark, sf, "supplier")
    desk = s.filter(F.col("s_nationkey") < 12).select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.concat(F.lower("s_name"), F.lit("@desk.io")).alias("email"),
        F.concat(F.lit("team "), F.col("s_nationkey").cast("string")).alias("team"),
        (F.col("s_acctbal") >= 0).alias("active"),
    )
    staff = s.filter(F.col("s_nationkey") >= 12).select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("staff_id"), F.col("s_name").alias("display_name"),
        F.concat(F.lower("s_name"), F.lit("@help.io")).alias("email"),
        F.concat(F.lit("Tier "), F.col("s_nationkey").cast("string")).alias("group"),
        F.when(F.col("s_acctbal") >= 0, "active").otherwise("deactivated").alias("status"),
    )
    return conform.common_agents(desk, staff)


def q_uncategorized_items(spark: SparkSession, sf: str) -> DataFrame:
    """Items logged but not mapped by the category seed (severity warn)."""
    out = quality.uncategorized_items(StandIns(spark, sf).bucketed)
    return out.select("item_name", F.col("entries").cast("bigint").alias("entries"),
                      F.col("hours").cast("decimal(18,2)").cast("double").alias("hours"))


def q_top_client_hours_chart(spark: SparkSession, sf: str) -> DataFrame:
    """The bar chart of the time-to-clients page - the ten external clients with
    the most client hours (ties broken by name), over the slicer's client list."""
    from ledgerflow.plans import pages

    s = StandIns(spark, sf)
    totals = reporting.client_totals(s.resolved, s.dim_client).select(
        "client_name", F.col("client_facing_hours").cast("double").alias("client_hours")
    )
    return pages.top_n(totals, "client_hours", 10, tie_breakers=("client_name",))


def q_employee_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """Employees with department, reporting group and employment status."""
    d = StandIns(spark, sf).dim_employee
    return d.select("employee_id", "employee_name", "department_name", "group_name", "hire_date",
                    "release_date", "employment_status", F.col("standard_hours_per_day").cast("double").alias("standard_hours_per_day"))


def q_schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Drift between two inferred schemas of event records (the plain event
    shape as 'committed', the mixed shape as 'fresh'): paths whose type, format or
    nullability differ, or that exist on one side only."""
    fresh = q_infer_mixed(spark, sf)
    committed = q_infer_events_props(spark, sf)
    return quality.schema_drift(fresh, committed)
