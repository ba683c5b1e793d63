"""Raw-side queries: text-typed extracts derived from the driver tables run through the
staging models and the vendor sources, each with its DuckDB oracle beside it; plus the load
checks, the declared model tests and the published contracts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators import quality
from ledgerflow.operators.infer import InferenceError, InferredSchema, PathType, infer_schema, path_text
from ledgerflow.operators.load import exclude_soft_deleted, extraction_order, load_job, read_table, rejected_records
from ledgerflow.operators.runs import RUNS_SCHEMA
from ledgerflow.plans import contracts, pages, reporting, staging
from ledgerflow.plans.standins import StandIns, for_driver
from ledgerflow.session import scratch_path, spread_skinny
from ledgerflow.sources import catalog, seeds
from ledgerflow.sources.records import read_json_lines, records_from_json
from ledgerflow.sources.vendors import load_pages, read_records, stream_pages
from ledgerflow.spec import IncrementalSpec, JobSpec
from ledgerflow.suite import elt_oracle, oracle

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _events(spark: SparkSession, sf: str) -> DataFrame:
    """The events, spread for the heavy work per row of making and parsing JSON."""
    return spread_skinny(_t(spark, sf, "events"))


# --- staging: raw text columns from a driver table (Spark SQL), and the expected model ---------

# model: (driver table, raw columns, oracle SQL). Full-refresh extracts also carry _run_id:
# rows of run-1 were not stamped again by run-2, so they are gone upstream
_GONE = "if({key} % 10 = 7, 'run-1', 'run-2') as _run_id"

STAGING: dict[str, tuple[str, list[str], str]] = {
    "accounts": ("part", ["cast(p_partkey as string) as id", "p_brand as acctnumber", "p_name as fullname", "p_type as accttype",
                          "if(p_size % 3 = 0, 'T', 'F') as isinactive", _GONE.format(key="p_partkey")],
                 """SELECT CAST(p_partkey AS INTEGER) AS account_id, p_brand AS account_number, p_name AS account_name,
                    p_type AS account_type, p_size % 3 = 0 AS is_inactive FROM part WHERE p_partkey % 10 <> 7"""),
    "customers": ("customer", ["cast(c_custkey as string) as id", "concat('C', c_custkey) as entityid", "c_name as companyname",
                               "if(c_nationkey > 20, 'T', if(c_nationkey = 0, null, 'F')) as isinactive"],
                  """SELECT CAST(c_custkey AS INTEGER) AS customer_id, 'C' || CAST(c_custkey AS VARCHAR) AS customer_number,
                     c_name AS customer_name, c_nationkey > 20 AS is_inactive,
                     c_name IN ('Customer#000000001', 'Customer#000000010') AS is_internal FROM customer"""),
    "departments": ("nation", ["cast(n_nationkey as string) as id", "n_name as name", "'F' as isinactive", _GONE.format(key="n_nationkey")],
                    """SELECT CAST(n_nationkey AS INTEGER) AS department_id, n_name AS department_name, false AS is_inactive
                       FROM nation WHERE n_nationkey % 10 <> 7"""),
    "employees": ("customer", ["cast(c_custkey as string) as id", "c_name as entityid", "cast(c_nationkey as string) as department",
                               "c_mktsegment as title", "date_format(date_add(date'2020-01-01', cast(c_custkey % 900 as int)), 'yyyy-MM-dd') as hiredate",
                               "cast(round(c_acctbal, 1) as string) as laborcost", "if(c_nationkey % 2 = 0, '7.5', null) as custentity_hours_per_day"],
                  """SELECT CAST(c_custkey AS INTEGER) AS employee_id, c_name AS employee_name, CAST(c_nationkey AS INTEGER) AS department_id,
                     c_mktsegment AS title, CAST(DATE '2020-01-01' + CAST(c_custkey % 900 AS INTEGER) AS DATE) AS hire_date,
                     CAST(round(c_acctbal, 1) AS DOUBLE) AS cost_per_hour,
                     CAST(CASE WHEN c_nationkey % 2 = 0 THEN 7.5 ELSE 8 END AS DOUBLE) AS standard_hours_per_day FROM customer"""),
    "items": ("part", ["cast(p_partkey as string) as id", "p_name as itemid", "p_brand as displayname", "p_type as itemtype",
                       "'no' as isinactive", _GONE.format(key="p_partkey")],
              """SELECT CAST(p_partkey AS INTEGER) AS item_id, p_name AS item_name, p_brand AS display_name, p_type AS item_type,
                 false AS is_inactive FROM part WHERE p_partkey % 10 <> 7"""),
    "projects": ("orders", ["cast(o_orderkey as string) as id", "concat('P', o_orderkey) as entityid", "cast(o_custkey as string) as parent",
                            "if(o_orderstatus = 'P', 'Open', concat(substring(o_orderpriority, 1, 1), '.  ', substring(o_orderpriority, 3))) as custentity_project_status",
                            "date_format(o_orderdate, 'yyyy-MM-dd') as startdate"],
                 """SELECT CAST(o_orderkey AS INTEGER) AS project_id, 'P' || CAST(o_orderkey AS VARCHAR) AS project_number,
                    CAST(o_custkey AS INTEGER) AS customer_id,
                    CASE WHEN o_orderstatus <> 'P' THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS project_status_rank,
                    CASE WHEN o_orderstatus = 'P' THEN 'Open' ELSE substr(o_orderpriority, 3) END AS project_status_label,
                    o_orderstatus <> 'P' AND CAST(substr(o_orderpriority, 1, 1) AS INTEGER) >= 4 AS is_complete,
                    CAST(o_orderdate AS DATE) AS start_date FROM orders"""),
    "time_entries": ("events", ["cast(event_id as string) as id", "cast(user_id as string) as employee", "date_format(ts, 'yyyy-MM-dd') as trandate",
                                "cast(cast(round(value, 2) as decimal(8,2)) as string) as hours", "if(event_type = 'click', 'T', 'F') as isbillable",
                                "event_type as memo"],
                     """SELECT CAST(event_id AS INTEGER) AS time_entry_id, CAST(user_id AS INTEGER) AS employee_id, CAST(ts AS DATE) AS entry_date,
                        CAST(CAST(round(value, 2) AS DECIMAL(8,2)) AS DOUBLE) AS hours, event_type = 'click' AS is_billable, event_type AS memo FROM events"""),
    "transactions": ("orders", ["cast(o_orderkey as string) as id", "concat('T', o_orderkey) as tranid",
                                "case o_orderpriority when '1-URGENT' then 'SalesOrd' when '2-HIGH' then 'VendBill' when '3-MEDIUM' then 'Opprtnty' "
                                "when '5-LOW' then 'Journal' else 'Other' end as type",
                                "o_orderstatus as status", "cast(o_custkey as string) as entity",
                                "cast(cast(o_totalprice as decimal(14,2)) as string) as foreigntotal", "date_format(o_orderdate, 'yyyy-MM-dd') as trandate"],
                     """SELECT CAST(o_orderkey AS INTEGER) AS transaction_id, 'T' || CAST(o_orderkey AS VARCHAR) AS document_number,
                        CASE o_orderpriority WHEN '1-URGENT' THEN 'Sales Order' WHEN '2-HIGH' THEN 'Bill' WHEN '3-MEDIUM' THEN 'Opportunity'
                          WHEN '5-LOW' THEN 'Journal' ELSE 'Other' END AS transaction_type_name,
                        o_orderstatus AS transaction_status, CAST(o_custkey AS INTEGER) AS entity_id,
                        CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS total_amount, CAST(o_orderdate AS DATE) AS transaction_date FROM orders"""),
    "transaction_lines": ("lineitem", ["cast(l_orderkey as string) as transaction", "cast(l_linenumber as string) as id",
                                       "cast(l_linenumber * 10 as string) as linesequencenumber", "if(l_linenumber = 1, 'T', 'F') as mainline",
                                       "cast(l_suppkey as string) as entity", "cast(l_partkey as string) as item", _GONE.format(key="l_orderkey")],
                          """SELECT CAST(l_orderkey AS INTEGER) AS transaction_id, CAST(l_linenumber AS INTEGER) AS line_id,
                             CAST(l_linenumber * 10 AS INTEGER) AS line_sequence, l_linenumber = 1 AS is_mainline,
                             CAST(l_suppkey AS INTEGER) AS entity_id, CAST(l_partkey AS INTEGER) AS item_id FROM lineitem WHERE l_orderkey % 10 <> 7"""),
    "transaction_accounting_lines": ("lineitem", ["cast(l_orderkey as string) as transaction", "cast(l_linenumber as string) as transactionline",
                                                  "cast(l_partkey as string) as account", "cast(cast(l_extendedprice as decimal(14,2)) as string) as amount",
                                                  "if(l_returnflag = 'R', 'F', 'T') as posting", _GONE.format(key="l_orderkey")],
                                     """SELECT CAST(l_orderkey AS INTEGER) AS transaction_id, CAST(l_linenumber AS INTEGER) AS line_id,
                                        CAST(l_partkey AS INTEGER) AS account_id, CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS DOUBLE) AS amount,
                                        l_returnflag <> 'R' AS is_posting FROM lineitem WHERE l_orderkey % 10 <> 7"""),
}
_SHOWN = {
    "customers": "customer_id customer_number customer_name is_inactive is_internal",
    "employees": "employee_id employee_name department_id title hire_date cost_per_hour standard_hours_per_day",
    "projects": "project_id project_number customer_id project_status_rank project_status_label is_complete start_date",
    "time_entries": "time_entry_id employee_id entry_date hours is_billable memo",
    "transactions": "transaction_id document_number transaction_type_name transaction_status entity_id total_amount transaction_date",
    "transaction_lines": "transaction_id line_id line_sequence is_mainline entity_id item_id",
}
INTERNAL_NAMES = ("Customer#000000001", "Customer#000000010")


def _snapshot_runs(spark: SparkSession, job: str) -> DataFrame:
    day = lambda d: datetime(2024, 2, d, tzinfo=UTC)
    rows = [{"run_id": f"run-{d}", "consumer": "erp", "job": job, "status": s, "started_at": day(d), "finished_at": day(d)}
            for d, s in ((1, "succeeded"), (2, "succeeded"), (3, "failed"))]
    full = [{f.name: r.get(f.name) for f in RUNS_SCHEMA.fields} for r in rows]
    return spark.createDataFrame(full, RUNS_SCHEMA)


def q_staging(spark: SparkSession, sf: str, model: str) -> DataFrame:
    table, columns, _ = STAGING[model]
    raw = _t(spark, sf, table).selectExpr(*columns)
    build = getattr(staging, f"stg_{model}")
    if "_run_id" in raw.columns:
        out = build(raw, _snapshot_runs(spark, model))
    else:
        out = build(raw, INTERNAL_NAMES) if model == "customers" else build(raw)
    return for_driver(out.select(*_SHOWN[model].split()) if model in _SHOWN else out)


# --- vendor sources: landed pages of every vendor -----------------------------------------------

# vendor: (job, driver table, key, other fields, per-row key that the source drops)
VENDORS = {
    "shopfront": ("orders", "orders", "o_orderkey", ["o_custkey as customer", "o_orderstatus as status"], None),
    "cartwheel": ("customers", "customer", "c_custkey", ["c_name as name", "c_nationkey % 5 = 0 as isDeleted"], None),
    "ticketdesk": ("tickets", "events", "event_id", ["event_type as subject", "user_id as requester"], None),
    "helpline": ("cases", "events", "event_id", ["event_type as topic"], None),
    "netsuite": ("items", "part", "p_partkey", ["p_name as itemid", "p_type as itemtype"], "links"),
    "salesforce": ("contacts", "customer", "c_custkey", ["c_name as Name", "c_mktsegment as Segment"], "attributes"),
}
PAGE_ROWS = 250


def _land(spark: SparkSession, sf: str, vendor: str) -> str:
    """A landing area with the vendor's rows in its envelope, ``PAGE_ROWS`` keys a page."""
    from ledgerflow.sources.vendors import ENVELOPES

    job, table, key, fields, dropped = VENDORS[vendor]
    envelope, _ = ENVELOPES[vendor]
    extra = [f"array(cast({key} as string)) as {dropped}"] if dropped else []
    rows = _t(spark, sf, table).selectExpr(f"{key} as id", *fields, *extra)
    rows = rows.select((F.col("id") / PAGE_ROWS).cast("long").alias("page"), F.struct(*rows.columns).alias("row"))
    pages = rows.groupBy("page").agg(F.sort_array(F.collect_list("row")).alias("rows"))  # a page is bounded
    doc = F.to_json(F.struct(F.col("rows").alias(envelope)) if envelope else F.col("rows"))
    landing = scratch_path(spark, f"landing-{vendor}")
    pages.select("page", doc.alias("value")).repartition(8, "page").write.partitionBy("page").option("maxRecordsPerFile", 1).text(f"{landing}/{job}")
    return landing


def _vendor_spec(vendor: str) -> JobSpec:
    return JobSpec(vendor, VENDORS[vendor][0], ("id",))


def _vendor_rows(records: DataFrame, vendor: str) -> DataFrame:
    """Key, fields, order and the dropped per-row key of landed records."""
    _, _, _, fields, dropped = VENDORS[vendor]
    names = [f.rsplit(" as ", 1)[1] for f in fields]
    gone = [F.variant_get("record", f"$.{dropped}", "string").isNull().alias("dropped")] if dropped else []
    return records.select(
        "ordinal.page", "ordinal.pos", F.variant_get("record", "$.id", "bigint").alias("id"),
        *[F.variant_get("record", f"$.{n}", "string").alias(n.lower()) for n in names], *gone)


def q_vendor(spark: SparkSession, sf: str, vendor: str) -> DataFrame:
    """The vendor's landed rows, read back through the source registry."""
    landing = _land(spark, sf, vendor)
    return _vendor_rows(read_records(spark, landing, _vendor_spec(vendor)), vendor)


def q_plugin(spark: SparkSession, sf: str, vendor: str) -> DataFrame:
    """G1: the same through ``spark.read.format("landed_pages")``."""
    return _vendor_rows(load_pages(spark, _land(spark, sf, vendor), _vendor_spec(vendor), partition_bytes="1000000"), vendor)


def q_plugin_stream(spark: SparkSession, sf: str, vendor: str) -> DataFrame:
    """G1: the same through ``spark.readStream.format("landed_pages")``, in micro-batches."""
    landing, out = _land(spark, sf, vendor), scratch_path(spark, f"streamed-{vendor}")
    rows = _vendor_rows(stream_pages(spark, landing, _vendor_spec(vendor), files_per_batch="40"), vendor)
    writer = rows.writeStream.option("checkpointLocation", scratch_path(spark, f"stream-{vendor}"))
    query = writer.trigger(processingTime="0 seconds").format("parquet").start(out)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.parquet(out)


def vendor_sql(vendor: str) -> str:
    _, table, key, fields, dropped = VENDORS[vendor]
    shown = ", ".join(f"CAST({e} AS VARCHAR) AS {n.lower()}" for e, n in (f.rsplit(" as ", 1) for f in fields))
    gone = ", true AS dropped" if dropped else ""
    return f"""SELECT {key} // {PAGE_ROWS} AS page, row_number() OVER (PARTITION BY {key} // {PAGE_ROWS} ORDER BY {key}) - 1 AS pos,
        {key} AS id, {shown}{gone} FROM {table}"""


# --- loads ---------------------------------------------------------------------------------------

_CHECKED = JobSpec("events", "checked", ("id",), IncrementalSpec("at", "2024-01-01T00:00:00", "%Y-%m-%dT%H:%M:%S"))
_TYPES = {"id": ("integer", None), "at": ("string", "date-time"), "day": ("string", "date"), "who": ("integer", None), "amount": ("number", None)}


def q_rejected_records(spark: SparkSession, sf: str) -> DataFrame:
    """Every event that a strict load would refuse, with all reasons. Clicks have no
    key, errors a fraction in an integer column, purchases a date with a time and a text where
    a number belongs, signups a field that the schema does not have."""
    text = F.expr("""concat('{',
        if(event_type = 'click', '', concat('"id":', event_id, ',')),
        '"at":"', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), '",',
        '"day":"', date_format(ts, if(event_type = 'purchase', "yyyy-MM-dd'T'HH:mm:ss", 'yyyy-MM-dd')), '",',
        '"who":', if(event_type = 'error', '0.5', cast(user_id as string)), ',',
        '"amount":', if(event_type = 'purchase', '"much"', cast(value as string)),
        if(event_type = 'signup', ',"bonus":1', ''), '}')""")
    events = _events(spark, sf).select(F.col("event_id").alias("ordinal"), text.alias("text"))
    schema = InferredSchema("events", "checked", ("id",), "at", "", 0, tuple(PathType((f".{n}",), t, False, f) for n, (t, f) in _TYPES.items()))
    out = rejected_records(records_from_json(events), schema, _CHECKED)
    return out.select(F.col("ordinal").alias("event_id"), F.array_join("reasons", "; ").alias("reasons"))


REJECTED_SQL = """
SELECT event_id, CASE event_type
  WHEN 'click' THEN 'key field ''id'' is null or missing'
  WHEN 'error' THEN 'field ''who'' is not integer but number'
  WHEN 'purchase' THEN 'field ''day'' is not a date: ' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '; field ''amount'' is not number but string'
  WHEN 'signup' THEN 'fields that the schema does not have: bonus' END AS reasons
FROM events WHERE event_type IN ('click', 'error', 'purchase', 'signup')"""


def q_landed_days_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Events land on two days, the later half with lower page numbers; the last
    write per user is the later day's, whatever its page."""
    late = F.col("ts") >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    ev = _t(spark, sf, "events")
    page = F.floor(F.col("event_id") / 1000) + F.when(late, 0).otherwise(100_000)
    line = F.to_json(F.struct("user_id", "event_id", "event_type"))
    landing = scratch_path(spark, "landing-days")
    (ev.select(F.when(late, "2024-01-16").otherwise("2024-01-15").alias("dt"), page.cast("long").alias("page"), "event_id", line.alias("value"))
       .repartition("dt", "page").sortWithinPartitions("dt", "page", "event_id").drop("event_id")
       .write.partitionBy("dt", "page").text(landing))
    spec, warehouse = JobSpec("landed", "users", ("user_id",)), scratch_path(spark, "landed-warehouse")
    kinds = {"user_id": "integer", "event_id": "integer", "event_type": "string"}
    schema = InferredSchema("landed", "users", ("user_id",), None, "", 0, tuple(PathType((f".{k}",), t) for k, t in kinds.items()))
    load_job(spark, lambda since: read_json_lines(spark, landing, "dt", since), spec, schema, warehouse)
    return read_table(spark, warehouse, "landed", "users").select("user_id", "event_id", "event_type")


LANDED_DAYS_SQL = """
SELECT user_id, event_id, event_type FROM (
  SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id
    ORDER BY ts >= TIMESTAMP '2024-01-15 00:00:00' DESC, event_id // 1000 DESC, event_id DESC) AS r FROM events)
WHERE r = 1"""


def q_infer_key_checks(spark: SparkSession, sf: str) -> DataFrame:
    """What inference says of four key choices over the events (props is absent from
    clicks, every field else is in each record)."""
    ev = _events(spark, sf)
    text = F.to_json(F.struct("event_id", "user_id", F.when(F.col("event_type") != "click", F.col("props")).alias("props")))
    records = records_from_json(ev.select(F.col("event_id").alias("ordinal"), text.alias("text")))
    rows = []
    for key in ("event_id", "user_id", "props", "other"):
        try:
            rows.append((key, "accepted", infer_schema(records, JobSpec("events", "keys", (key,))).records_scanned))
        except InferenceError as error:
            rows.append((key, str(error).split(": ", 1)[1], None))
    return spark.createDataFrame(rows, "key string, verdict string, records long")


KEY_CHECKS_SQL = """
SELECT key, verdict, CASE WHEN verdict = 'accepted' THEN (SELECT count(*) FROM events) END AS records FROM (
  SELECT 'event_id' AS key, CASE WHEN (SELECT count(*) FROM events WHERE event_id IS NULL) = 0 THEN 'accepted' END AS verdict UNION ALL
  SELECT 'user_id', CASE WHEN (SELECT count(*) FROM events WHERE user_id IS NULL) = 0 THEN 'accepted' END UNION ALL
  SELECT 'props', CASE WHEN (SELECT count(*) FROM events WHERE event_type = 'click' OR props IS NULL) > 0
    THEN 'the key field ''props'' is null or missing in some records' ELSE 'accepted' END UNION ALL
  SELECT 'other', 'no record has the key field ''other''')"""


# --- catalog, saved schemas, paging, soft deletes, set equality -------------------------------------

def q_item_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """The item dimension, joined to the items that events name (every item is used)."""
    s = StandIns(spark, sf)
    used = s.time_entries.groupBy("item_id").agg(F.count(F.lit(1)).alias("entries"))
    return s.dim_item.join(used, "item_id").select(
        "item_id", "item_name", "category_code", "category_name", "counts_as_worked", "is_client_facing", "entries")


def q_saved_schema(spark: SparkSession, sf: str) -> DataFrame:
    """The schema inferred from the events, written as its document, read back and
    shown path by path."""
    ev = _events(spark, sf)
    text = F.to_json(F.struct(F.col("event_id").alias("id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("at"), "user_id",
                              F.array("event_type").alias("tags"), F.from_json("props", "k bigint").alias("props"), "value"))
    records = records_from_json(ev.select(F.col("event_id").alias("ordinal"), text.alias("text")))
    root = scratch_path(spark, "schemas")
    catalog.write_schema(spark, infer_schema(records, JobSpec("events", "saved", ("id",))), root)
    schema = catalog.read_schema(spark, root, "events", "saved")
    rows = [(path_text(p.path), p.type, p.format, p.nullable, schema.records_scanned) for p in schema.paths]
    return spark.createDataFrame(rows, "path string, type string, format string, nullable boolean, records long")


SAVED_SCHEMA_SQL = """
SELECT path, type, format, nullable, (SELECT count(*) FROM events) AS records FROM (VALUES
  ('id', 'integer', NULL, false), ('at', 'string', 'date-time', false), ('user_id', 'integer', NULL, false),
  ('tags', 'array', NULL, false), ('tags[]', 'string', NULL, false), ('props', 'object', NULL, false),
  ('props.k', 'integer', NULL, false), ('value', 'number', NULL, false)) AS v(path, type, format, nullable)"""


def q_catalog_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Logical sources resolved by the catalog, one of them by an override."""
    c = catalog.Catalog(root=f"{sf}/..", schema=sf.rstrip("/").rsplit("/", 1)[1],
                        overrides={n: f"{sf}/{n}.parquet" for n in ("orders", "customer")})
    per = c.source(spark, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    people = c.source(spark, "customer")
    return people.join(per, people["c_custkey"] == per["o_custkey"]).groupBy("c_mktsegment").agg(F.sum("orders").alias("orders"))


def q_first_page(spark: SparkSession, sf: str) -> DataFrame:
    """L2/L3: the first page of 500 orders in extraction order - by change time, then id."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    return extraction_order(o, "o_orderdate", "o_orderkey").limit(500)


def q_soft_deletes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows flagged as deleted upstream travel on by default and go on request."""
    flagged = _t(spark, sf, "customer").select(
        "c_mktsegment", F.when(F.col("c_nationkey") > 3, F.col("c_nationkey") % 4 == 0).alias("isDeleted"))
    modes = [exclude_soft_deleted(flagged, include_deleted=keep).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("rows")).withColumn("include_deleted", F.lit(keep)) for keep in (True, False)]
    return modes[0].unionByName(modes[1])


def q_set_equality(spark: SparkSession, sf: str) -> DataFrame:
    """Whether two results are equal as multisets: line totals summed two ways, and the
    same with one status left out."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linestatus", F.col("l_quantity").cast("decimal(20,2)").alias("q"))
    whole = li.groupBy("l_orderkey").agg(F.sum("q").cast("decimal(38,2)").alias("q"))
    parts = li.groupBy("l_orderkey", "l_linestatus").agg(F.sum("q").cast("decimal(38,2)").alias("q"))
    again = parts.groupBy("l_orderkey").agg(F.sum("q").cast("decimal(38,2)").alias("q"))
    short = parts.where("l_linestatus = 'O'").groupBy("l_orderkey").agg(F.sum("q").cast("decimal(38,2)").alias("q"))
    rows = [("in two steps", quality.set_equal(whole, again)), ("one status", quality.set_equal(whole, short))]
    return spark.createDataFrame(rows, "summed string, equal boolean")


SET_EQUALITY_SQL = """
WITH a AS (SELECT l_orderkey, sum(CAST(l_quantity AS DECIMAL(20,2))) AS q FROM lineitem GROUP BY 1),
b AS (SELECT l_orderkey, sum(CAST(l_quantity AS DECIMAL(20,2))) AS q FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1)
SELECT 'in two steps' AS summed, true AS equal UNION ALL
SELECT 'one status', (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) = 0 AND (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) = 0"""


# --- declared tests and contracts ------------------------------------------------------------------

def _models(s: StandIns) -> dict[str, DataFrame]:
    return {
        "dim_date": s.dim_date, "dim_employee": s.dim_employee, "dim_client": s.dim_client, "dim_project": s.dim_project,
        "dim_item": s.dim_item, "fct_time_entries": s.categorized, "fct_employee_capacity": s.capacity,
        "fct_project_financials": s.financial_lines,
    }


def _published(s: StandIns) -> dict[str, DataFrame]:
    reports = {
        "rpt_utilization_weekly": reporting.utilization_weekly(s.capacity, s.bucketed, s.dim_employee),
        "rpt_client_hours": reporting.client_hours(s.resolved, s.dim_client, s.dim_employee),
        "rpt_top_clients": reporting.top_clients(s.resolved, s.dim_client, n=15),
        "rpt_task_breakdown": reporting.task_breakdown(s.resolved, s.dim_employee, s.dim_project, s.dim_client, s.dim_item),
        "rpt_project_margin": reporting.project_margin_from(s.dim_project, s.financial_lines, s.project_time),
    }
    return {n: reporting.publish(n, df) for n, df in _models(s).items() if n in contracts.CONTRACTS} | reports


def q_model_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Q9: the tests declared for the marts, run as one list."""
    return quality.run_checks(_models(StandIns(spark, sf)), contracts.model_checks())


def q_project_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Every declared test over staging, seeds, intermediate models, marts and
    reports in one run. The shown calendar lacks a day and the shown work categories one
    item, so a relationship and an accepted-values test fail on purpose."""
    s = StandIns(spark, sf)
    tables = _models(s) | {f"stg_{m}": q_staging(spark, sf, m) for m in STAGING} | {
        "int_calendar": s.calendar, "int_time_entries__categorized": s.categorized, "int_employee_days": s.capacity,
        "time_categories": seeds.time_categories(spark).withColumn(
            "category_code", F.when(F.col("item_name") == "FMLA", "leave").otherwise(F.col("category_code"))),
        "account_classes": seeds.account_classes(spark), "department_groups": seeds.department_groups(spark),
        "rpt_utilization_weekly": reporting.utilization_weekly(s.capacity, s.bucketed, s.dim_employee),
        "rpt_top_clients": reporting.top_clients(s.resolved, s.dim_client, n=15),
        "rpt_project_margin": reporting.project_margin_from(s.dim_project, s.financial_lines, s.project_time),
        "dim_date": s.dim_date.where("date_day <> date'2024-01-10'"),
    }
    return quality.run_checks(tables, contracts.project_checks())


def q_model_contracts(spark: SparkSession, sf: str) -> DataFrame:
    """All twelve published models against their contracts; no dimension or fact
    among them shows a rate or a per-entry cost (the margin report has costs per project)."""
    out = None
    for name, df in _published(StandIns(spark, sf)).items():
        contract = T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in contracts.CONTRACTS[name]])
        quality.assert_contract(df, contract)
        report = quality.contract_report(df, contract).select(
            F.lit(name).alias("model"), "column", "actual_type", "uncastable", "rows_checked",
            (F.col("column").isin(*reporting.REDACTED_COLUMNS) & F.lit(not name.startswith("rpt_"))).alias("leaks"))
        out = report if out is None else out.unionByName(report)
    return out


MARGIN_MEASURES = ("Price", "Net Revenue", "Project Profit", "Project Profit %", "Contribution Margin", "Contribution Margin %")


def q_margin_by_client(spark: SparkSession, sf: str) -> DataFrame:
    """M13-M18 through the star: the margin measures by client and project status with
    subtotals, the same measures at any grain of the project dimension."""
    s = StandIns(spark, sf)
    margin = reporting.project_margin_from(s.dim_project, s.financial_lines, s.project_time)
    star = pages.Star(facts={"project_margin": margin}, dims={"project": s.dim_project})
    return for_driver(pages.pivot(star, [("project", "client_name"), ("project", "project_status_label")], list(MARGIN_MEASURES)))


def margin_by_client_sql() -> str:
    """Sums of the margin report on exact cents, rolled up."""
    cents = {c: f"sum(CAST(round({c} * 100) AS HUGEINT))" for c in ("price", "net_revenue", "project_profit", "contribution_margin")}
    shown = ", ".join(f"CAST({v} AS DOUBLE) / 100 AS {c}" for c, v in cents.items())
    ratio = lambda c: f"CASE WHEN {cents['net_revenue']} <> 0 THEN CAST({cents[c]} AS DOUBLE) / CAST({cents['net_revenue']} AS DOUBLE) END"
    return f"""SELECT client_name, project_status_label, CAST(GROUPING(client_name, project_status_label) AS INTEGER) AS grouping_level,
        {shown}, {ratio('project_profit')} AS project_profit_pct, {ratio('contribution_margin')} AS contribution_margin_pct
        FROM ({oracle.project_margin_sql()}) AS m GROUP BY ROLLUP (client_name, project_status_label)"""


def _values_sql(columns: str, rows: list[tuple]) -> str:
    quoted = ", ".join("(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {quoted}) AS v({columns})"


def _sources() -> dict[str, str]:
    """Each checked model's rows, in SQL."""
    return {
        "dim_date": oracle.date_dimension_sql(), "dim_employee": elt_oracle.employee_dimension_sql(),
        "dim_client": oracle.with_(oracle.CLIENTS) + "SELECT client_id FROM clients",
        "dim_project": oracle.with_(oracle.PROJ) + "SELECT project_id FROM proj",
        "dim_item": oracle.with_(oracle.ITEMS) + "SELECT item_id FROM items",
        "fct_time_entries": oracle.categorized_entries_sql(),
        "fct_employee_capacity": oracle.employee_days_sql(), "fct_project_financials": oracle.financial_lines_sql(),
    } | {f"stg_{m}": sql for m, (_, _, sql) in STAGING.items()} | {
        "int_calendar": oracle.calendar_sql(), "int_time_entries__categorized": oracle.categorized_entries_sql(),
        "int_employee_days": oracle.employee_days_sql(),
        "time_categories": _values_sql("item_name, category_code", [(r[0], "leave" if r[0] == "FMLA" else r[1]) for r in seeds.TIME_CATEGORIES]),
        "account_classes": _values_sql("account_number, account_class", [r[:2] for r in seeds.ACCOUNT_CLASSES]),
        "department_groups": _values_sql("department_name, group_name", seeds.DEPARTMENT_GROUPS),
        "rpt_utilization_weekly": oracle.utilization_weekly_sql(), "rpt_top_clients": oracle.top_clients_sql(),
        "rpt_project_margin": oracle.project_margin_sql(),
    }


def _checks_sql(checks: list[quality.Check], source: dict[str, str]) -> str:
    models = dict.fromkeys(m for c in checks for m in (c.table, c.params.get("to")) if m)
    parts = []
    for c in checks:
        keys, first = ", ".join(c.columns), c.columns[0]
        if c.kind == "not_null":
            counted = f"SELECT count(*) FROM m_{c.table} WHERE {first} IS NULL"
        elif c.kind == "accepted_values":
            listed = ", ".join(repr(v) for v in c.params["values"])
            counted = f"SELECT count(*) FROM m_{c.table} WHERE {first} NOT IN ({listed})"
        elif c.kind == "relationships":
            counted = (f"SELECT count(*) FROM m_{c.table} AS x WHERE {first} IS NOT NULL AND NOT EXISTS "
                       f"(SELECT 1 FROM m_{c.params['to']} AS y WHERE y.{c.params['field']} = x.{first})")
        else:
            known = f"WHERE {first} IS NOT NULL" if c.kind == "unique" else ""
            counted = f"SELECT count(*) FROM (SELECT {keys} FROM m_{c.table} {known} GROUP BY {keys} HAVING count(*) > 1)"
        parts.append(elt_oracle._check(c.name, c.severity, counted))
    return "WITH " + ",\n".join(f"m_{m} AS MATERIALIZED ({source[m]})" for m in models) + "\n" + "\nUNION ALL\n".join(parts)


def model_checks_sql() -> str:
    return _checks_sql(contracts.model_checks(), _sources())


def project_checks_sql() -> str:
    source = _sources()
    source["dim_date"] = f"SELECT * FROM ({source['dim_date']}) WHERE date_day <> DATE '2024-01-10'"
    return _checks_sql(contracts.project_checks(), source)


def model_contracts_sql() -> str:
    counts = {
        "dim_date": oracle.date_dimension_sql(), "dim_employee": "SELECT 1 FROM customer", "dim_client": "SELECT 1 FROM customer",
        "dim_project": "SELECT 1 FROM orders", "dim_item": "SELECT 1 FROM (VALUES (1), (2), (3), (4), (5))", "fct_time_entries": "SELECT 1 FROM events",
        "fct_employee_capacity": oracle.employee_days_sql(), "rpt_utilization_weekly": oracle.utilization_weekly_sql(),
        "rpt_client_hours": oracle.client_hours_sql(), "rpt_top_clients": oracle.top_clients_sql(),
        "rpt_task_breakdown": oracle.task_breakdown_sql(), "rpt_project_margin": oracle.project_margin_sql(),
    }
    parts = []
    for name, columns in contracts.CONTRACTS.items():
        values = ", ".join(f"('{c}', '{t}')" for c, t in columns)
        parts.append(f"""SELECT '{name}' AS model, c AS "column", t AS actual_type, CAST(0 AS BIGINT) AS uncastable,
            (SELECT count(*) FROM ({counts[name]}) AS m) AS rows_checked, false AS leaks FROM (VALUES {values}) AS v(c, t)""")
    return "\nUNION ALL\n".join(parts)


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {f"stg_{m}": partial(q_staging, model=m) for m in STAGING}
    found |= {f"vendor_{v}": partial(q_vendor, vendor=v) for v in VENDORS}
    found |= {f"plugin_{v}": partial(q_plugin, vendor=v) for v in ("netsuite", "ticketdesk")}
    found |= {"plugin_stream_helpline": partial(q_plugin_stream, vendor="helpline")}
    return found | {
        "rejected_records": q_rejected_records,
        "landed_days_upsert": q_landed_days_upsert,
        "infer_key_checks": q_infer_key_checks,
        "item_dimension": q_item_dimension,
        "saved_schema": q_saved_schema,
        "catalog_sources": q_catalog_sources,
        "first_page": q_first_page,
        "soft_deletes": q_soft_deletes,
        "set_equality": q_set_equality,
        "margin_by_client": q_margin_by_client,
        "model_checks": q_model_checks,
        "project_checks": q_project_checks,
        "model_contracts": q_model_contracts,
    }


def oracle_sql() -> dict[str, str]:
    found = {f"stg_{m}": sql for m, (_, _, sql) in STAGING.items()} | {f"vendor_{v}": vendor_sql(v) for v in VENDORS}
    found |= {"plugin_netsuite": vendor_sql("netsuite"), "plugin_ticketdesk": vendor_sql("ticketdesk"),
              "plugin_stream_helpline": vendor_sql("helpline")}
    return found | {
        "rejected_records": REJECTED_SQL,
        "landed_days_upsert": LANDED_DAYS_SQL,
        "infer_key_checks": KEY_CHECKS_SQL,
        "item_dimension": oracle.with_(oracle.TE, oracle.ITEMS, oracle.CATS) + """
            SELECT it.item_id, it.item_name, coalesce(c.category_code, 'unmapped') AS category_code,
              coalesce(c.category_name, 'Unmapped') AS category_name, coalesce(c.counts_as_worked, false) AS counts_as_worked,
              coalesce(c.is_client_facing, false) AS is_client_facing, (SELECT count(*) FROM te WHERE te.item_id = it.item_id) AS entries
            FROM items it LEFT JOIN cats c ON lower(c.item_name) = lower(it.item_name)""",
        "saved_schema": SAVED_SCHEMA_SQL,
        "catalog_sources": "SELECT c_mktsegment, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1",
        "first_page": "SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 500",
        "soft_deletes": """SELECT c_mktsegment, count(*) AS rows, true AS include_deleted FROM customer GROUP BY 1 UNION ALL
            SELECT c_mktsegment, count(*), false FROM customer WHERE NOT (c_nationkey > 3 AND c_nationkey % 4 = 0) GROUP BY 1""",
        "set_equality": SET_EQUALITY_SQL,
        "margin_by_client": margin_by_client_sql(),
        "model_checks": model_checks_sql(),
        "project_checks": project_checks_sql(),
        "model_contracts": model_contracts_sql(),
    }
