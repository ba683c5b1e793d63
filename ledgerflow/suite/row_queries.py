"""Registered queries for the survey rows that no other query runs: the describe-driven
column list (S9), typed seed files (S10), added columns (K3), published views (K6), the
unix-seconds bound (F3), column types of an inferred schema (I10), key agreement (U8) and the
model parameters (G4). Each oracle stands beside its query."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators.infer import infer_schema
from ledgerflow.operators.load import LoadError, check_keys, incremental_filter, upsert
from ledgerflow.plans import intermediate, models, reporting
from ledgerflow.plans.standins import StandIns, for_driver
from ledgerflow.session import scratch_path
from ledgerflow.sources.records import describe_columns, records_from_json
from ledgerflow.sources.seeds import read_seed_csv
from ledgerflow.spec import IncrementalSpec, JobSpec, ModelParams
from ledgerflow.suite import elt_oracle, oracle
from ledgerflow.suite.elt_queries import mixed_records


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def q_described_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as the fields of a describe document, two regions as compound types; the
    customers of the described fields."""
    kind = F.when(F.col("n_regionkey") == 1, "address").when(F.col("n_regionkey") == 2, "location").otherwise("string")
    named = describe_columns(_t(spark, sf, "nation").select(F.col("n_name").alias("name"), kind.alias("type")))
    nations = _t(spark, sf, "nation").where(F.col("n_name").isin(*named))
    return _t(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(
        F.col("n_name").alias("field")).agg(F.count("*").alias("customers"))


DESCRIBED_SQL = """SELECT n_name AS field, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_regionkey NOT IN (1, 2) GROUP BY n_name"""


def q_seed_file(spark: SparkSession, sf: str) -> DataFrame:
    """Customers written as a CSV seed and read with declared types; quotes, commas and
    missing values come back."""
    path = scratch_path(spark, "seed")
    c = _t(spark, sf, "customer")
    note = F.when(F.col("c_nationkey") % 3 != 0, F.concat(F.lit('say "'), F.col("c_mktsegment"), F.lit('", twice')))
    c.select("c_custkey", "c_name", F.round("c_acctbal", 2).alias("c_acctbal"), (F.col("c_nationkey") > 9).alias("far"),
             F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 900).cast("int")).alias("since"), note.alias("note")) \
        .write.option("header", True).option("escape", '"').csv(path)
    declared = T.StructType([T.StructField(n, t) for n, t in (
        ("c_custkey", T.LongType()), ("c_name", T.StringType()), ("c_acctbal", T.DoubleType()), ("far", T.BooleanType()),
        ("since", T.DateType()), ("note", T.StringType()))])
    return read_seed_csv(spark, path, declared)


SEED_SQL = """SELECT c_custkey, c_name, round(c_acctbal, 2) AS c_acctbal, c_nationkey > 9 AS far,
CAST(DATE '2020-01-01' + CAST(c_custkey % 900 AS INTEGER) AS DATE) AS since,
CASE WHEN c_nationkey % 3 <> 0 THEN 'say "' || c_mktsegment || '", twice' END AS note FROM customer"""


def q_added_columns(spark: SparkSession, sf: str) -> DataFrame:
    """K3: a batch with a column that the table lacks; rows of before have NULL in it, and the
    batch's rows have NULL where it lacks a column."""
    o = _t(spark, sf, "orders")
    table = o.where(F.col("o_orderkey") % 3 != 0).select("o_orderkey", "o_orderstatus", "o_custkey")
    batch = o.where(F.col("o_orderkey") % 2 == 0).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return upsert(table, batch, ["o_orderkey"])


ADDED_SQL = """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 1 THEN o_custkey END AS o_custkey,
CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0"""


def q_published_views(spark: SparkSession, sf: str) -> DataFrame:
    """K6: two models published as views and as tables, read back through SQL."""
    s, path = StandIns(spark, sf), scratch_path(spark, "published")
    chosen = {"rpt_client_hours": reporting.client_hours(s.resolved, s.dim_client, s.dim_employee), "reporting_dim_client": s.dim_client}
    models.publish(chosen, path)
    spark.read.parquet(f"{path}/reporting_dim_client").createOrReplaceTempView("written_clients")
    return for_driver(spark.sql("""SELECT c.client_number, sum(h.total_hours) AS total_hours FROM rpt_client_hours AS h
        JOIN written_clients AS c ON c.client_id = h.client_id GROUP BY c.client_number"""))


def published_sql() -> str:
    return f"""SELECT CAST(client_id AS VARCHAR) AS client_number, CAST(sum(CAST(total_hours AS DECIMAL(20,2))) AS DOUBLE) AS total_hours
FROM ({oracle.client_hours_sql()}) GROUP BY client_id"""


def q_epoch_bound(spark: SparkSession, sf: str) -> DataFrame:
    """a key in unix seconds, an inclusive bound; records without a key are not selected."""
    spec = JobSpec("feed", "ticks", ("id",), IncrementalSpec("at", "0", "epoch"))
    ev = _t(spark, sf, "events")
    at = F.when(F.col("event_id") % 11 != 0, F.unix_seconds(F.col("ts").cast("timestamp")))
    text = F.to_json(F.struct(F.col("event_id").alias("id"), at.alias("at")))
    records = records_from_json(ev.select(F.col("event_id").alias("ordinal"), text.alias("text")))
    found = incremental_filter(records, spec, datetime(2024, 1, 20, 12, tzinfo=UTC))
    return found.select(*[F.variant_get("record", f"$.{c}", "bigint").alias(c) for c in ("id", "at")])


EPOCH_SQL = """SELECT event_id AS id, CAST(floor(epoch(ts)) AS BIGINT) AS at FROM events
WHERE event_id % 11 <> 0 AND floor(epoch(ts)) >= epoch(TIMESTAMP '2024-01-20 12:00:00')"""


def q_column_types(spark: SparkSession, sf: str) -> DataFrame:
    """The table columns of the inferred schema of the mixed records."""
    schema = infer_schema(mixed_records(spark, sf), JobSpec("events", "mixed", ("id",)))
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in schema.to_struct_type() if not f.name.startswith("_")]
    return spark.createDataFrame(rows, "column string, type string, nullable boolean")


def column_types_sql() -> str:
    return f"""SELECT path AS "column", CASE WHEN format = 'date' THEN 'date' WHEN format = 'date-time' THEN 'timestamp'
  WHEN type = 'integer' THEN 'bigint' WHEN type = 'number' THEN 'double' WHEN type IN ('object', 'array') THEN 'variant'
  WHEN type = 'boolean' THEN 'boolean' ELSE 'string' END AS type, path <> 'id' AS nullable
FROM ({elt_oracle.infer_mixed_sql()}) WHERE path NOT LIKE '%.%' AND path NOT LIKE '%[]'"""


def q_key_agreement(spark: SparkSession, sf: str) -> DataFrame:
    """U8: every field of the mixed records that could be the job's key, against a schema that
    was inferred for ``id``."""
    schema = infer_schema(mixed_records(spark, sf), JobSpec("events", "mixed", ("id",)))
    rows = []
    for name in schema.fields:
        try:
            check_keys(JobSpec("events", "mixed", (name,)), schema)
            rows.append((name, "agrees", schema.records_scanned))
        except LoadError:
            rows.append((name, "refused", schema.records_scanned))
    return spark.createDataFrame(rows, "key string, verdict string, records long")


def key_agreement_sql() -> str:
    return f"""SELECT path AS key, CASE WHEN path = 'id' THEN 'agrees' ELSE 'refused' END AS verdict, (SELECT count(*) FROM events) AS records
FROM ({elt_oracle.infer_mixed_sql()}) WHERE path NOT LIKE '%.%' AND path NOT LIKE '%[]'"""


PARAMS = ModelParams(calendar_start="2024-01-07", calendar_end="2024-01-20", top_clients=3)


def q_model_parameters(spark: SparkSession, sf: str) -> DataFrame:
    """Another calendar and another number of top clients; the clients marked as top, on
    each day of the calendar with their hours of that day."""
    s = StandIns(spark, sf)
    days = intermediate.calendar(s.time_entries, PARAMS.calendar_start, PARAMS.calendar_end)
    ranked = reporting.top_clients(s.resolved, s.dim_client, n=PARAMS.top_clients)
    flag = next(c for c in ranked.columns if c.startswith("is_top"))
    top = ranked.where(F.col(flag)).select("client_id", "client_rank")
    hours = s.resolved.groupBy("client_id", "entry_date").agg(F.sum("hours").alias("hours"))
    held = hours.join(days, hours["entry_date"] == days["date_day"]).join(F.broadcast(top), "client_id")  # as many as the parameter says
    return for_driver(held.select("date_day", "is_weekday", "client_id", "client_rank", "hours"))


def model_parameters_sql() -> str:
    return f"""SELECT date_day, is_weekday, c.client_id, client_rank, CAST(sum(CAST(hours AS DECIMAL(20,2))) AS DOUBLE) AS hours
FROM ({oracle.categorized_entries_sql()}) AS c JOIN ({oracle.calendar_sql()}) AS d ON c.entry_date = d.date_day
JOIN ({oracle.top_clients_sql()}) AS t ON t.client_id = c.client_id
WHERE client_rank <= 3 AND date_day BETWEEN DATE '2024-01-07' AND DATE '2024-01-20' GROUP BY ALL"""


def queries() -> dict:
    return {
        "described_columns": q_described_columns,
        "seed_file": q_seed_file,
        "added_columns": q_added_columns,
        "published_views": q_published_views,
        "epoch_bound": q_epoch_bound,
        "column_types": q_column_types,
        "key_agreement": q_key_agreement,
        "model_parameters": q_model_parameters,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "described_columns": DESCRIBED_SQL,
        "seed_file": SEED_SQL,
        "added_columns": ADDED_SQL,
        "published_views": published_sql(),
        "epoch_bound": EPOCH_SQL,
        "column_types": column_types_sql(),
        "key_agreement": key_agreement_sql(),
        "model_parameters": model_parameters_sql(),
    }
