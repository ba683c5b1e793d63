"""The run log: schema, latest successful run per job (W2), snapshot filter (F7),
saved watermark (W4). All are aggregates, never a global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_ID = "_run_id"
LOADED_AT = "_loaded_at"

RUNS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("consumer", T.StringType(), False),
        T.StructField("job", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("started_at", T.TimestampType(), False),
        T.StructField("finished_at", T.TimestampType(), True),
        T.StructField("records_loaded", T.LongType(), True),
        T.StructField("lower_bound", T.StringType(), True),
        T.StructField("max_incremental_value", T.StringType(), True),
        T.StructField("error", T.StringType(), True),
    ]
)


def latest_successful_run(runs: DataFrame) -> DataFrame:
    """One row per job: the run id of its latest succeeded run.

    ``max_by`` is a partial+final aggregate, so a job with millions of runs still
    combines map-side; no ORDER BY ... LIMIT over the whole log.
    """
    return (
        runs.filter(F.col("status") == "succeeded")
        .groupBy("job")
        .agg(F.max_by("run_id", "finished_at").alias("run_id"))
    )


def latest_snapshot(table: DataFrame, runs: DataFrame, job: str) -> DataFrame:
    """Keep only the rows stamped by the job's latest successful run.

    Rows a full-refresh run did not re-stamp were deleted upstream. No successful run
    means no rows, as with the scalar-subquery form. The run side is at most one row,
    so broadcasting it is bounded by construction.
    """
    latest = (
        latest_successful_run(runs.filter(F.col("job") == job))
        .select(F.col("run_id").alias("__latest_run"))
    )
    return (
        table.join(F.broadcast(latest), F.col(RUN_ID) == F.col("__latest_run"), "inner")
        .drop("__latest_run")
    )


def append_snapshot(rows: DataFrame, path: str, run_id: str) -> None:
    """Add one full-refresh run to a table laid out by run: its rows in a folder of their
    own. The same run again replaces itself."""
    rows.withColumn(RUN_ID, F.lit(run_id)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(RUN_ID).parquet(path)


def read_snapshot(spark: SparkSession, path: str, runs: DataFrame, job: str) -> DataFrame:
    """The rows of the job's latest successful run (F7/U7) from a table laid out by run: the
    run id found in the log reaches the scan as a dynamic partition filter, so the folders
    of all other runs are neither listed for reading nor opened."""
    return latest_snapshot(spark.read.parquet(path), runs, job)


def saved_watermarks(runs: DataFrame) -> DataFrame:
    """The saved high-water mark of every (consumer, job) (W4): the
    ``max_incremental_value`` of the latest finished succeeded run that has one.
    Failed and still-running runs never count (U3). Equal finish times are broken by
    run id so the answer is deterministic. One partial+final aggregate per job."""
    return (
        runs.filter((F.col("status") == "succeeded") & F.col("max_incremental_value").isNotNull())
        .groupBy("consumer", "job")
        .agg(
            F.max_by("max_incremental_value", F.struct("finished_at", "run_id")).alias("watermark"),
            F.max("finished_at").alias("finished_at"),
        )
    )


def last_watermark(runs: DataFrame, consumer: str, job: str) -> DataFrame:
    """One-row frame with the saved high-water mark of (consumer, job)."""
    one = runs.filter((F.col("consumer") == consumer) & (F.col("job") == job))
    return saved_watermarks(one).select("watermark")
