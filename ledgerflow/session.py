"""Session construction and the shared checkpoint location.

On a cluster the checkpoint folder is named by ``spark.checkpoint.dir`` (a shared,
durable path). We only invent one when the setting is absent *and* the master is
local (tests, laptops); a cluster session without the setting is an error rather
than a silent machine-local folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def get_session(
    master: str | None = None,
    app_name: str = "ledgerflow",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    # a cluster coalesces small shuffles to the advisory size (fewer, fuller tasks on
    # shared executors); a local master is a dedicated machine, where Spark's default -
    # keep at least one partition per core - finishes small shuffles sooner
    local = (master or "").startswith("local")
    builder = builder.config("spark.sql.adaptive.coalescePartitions.parallelismFirst", str(local).lower())
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session; sets a private temporary one only
    for local masters where it is unset.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared checkpoint folder"
            )
        configured = tempfile.mkdtemp(prefix="ledgerflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written intermediate table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str):
    """Write ``df`` as a Parquet table under the shared checkpoint folder and read it back:
    cuts lineage (a lost executor recomputes nothing before this point) in one job."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, in any store that Spark reads."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(conf).exists(place)


SKINNY_BYTES = 1 << 20  # of a share of an input that is spread; more slots than one only beyond it
WAVES = 4


def spread_skinny(df):
    """Round-robin ``df`` when its splits are too few to keep the task slots busy (a file of
    one or a few large row groups), so heavy per-row work after it runs in parallel: over all
    slots, and over up to ``WAVES`` times as many shares as the input grows. Inputs with more
    splits are returned unchanged.

    Call it on the narrow scan, before the heavy work: what is worked out below it still
    runs in the few splits."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution()
    wanted = max(cores, min(WAVES * cores, int(plan.optimizedPlan().stats().sizeInBytes()) // SKINNY_BYTES))
    # a frame that holds a shuffle says how many partitions it gives (scans say 0); counting
    # them through the RDD would run the shuffle's map stages
    held = plan.sparkPlan().outputPartitioning().numPartitions() or df.rdd.getNumPartitions()
    return df if held >= wanted else df.repartition(wanted)


# Settings the library's results depend on (not tuning): instants are rendered and
# parsed in UTC, and casts are ANSI-strict.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


# set where the caller has not. Shuffled rows of the models shrink to a tenth or less, so
# Spark's 64 MB of shuffled bytes for a task are over a gigabyte in its sorts and aggregates
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the semantic settings and the checkpoint folder to an existing session
    (e.g. one created by a caller with other defaults)."""
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in SESSION_DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: int, executor_cores_total: int) -> dict[str, str]:
    """Starting settings for a cluster run over ``input_bytes`` of Parquet input with
    ``executor_cores_total`` task slots: ~256 MB scan splits; initial shuffle partitions
    of ~512 MB of input each (projection and partial aggregation shrink shuffles well
    below the input), at least two waves of tasks and as many more as the input needs -
    AQE then coalesces small partitions and splits skewed ones; a broadcast threshold, applied to decoded-size
    estimates, that keeps broadcasts to genuinely small dimensions."""
    mb = 1024 * 1024
    cores = max(1, executor_cores_total)
    shuffle = max(cores * 2, input_bytes // (512 * mb))
    return {
        "spark.sql.files.maxPartitionBytes": str(256 * mb),
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * mb),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * mb),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * mb),
        # plan-time broadcast decisions use Parquet file sizes, which understate the
        # decoded size several-fold; scale the estimate so only truly small relations
        # qualify (runtime AQE decisions use the measured shuffle sizes instead)
        "spark.sql.sources.fileCompressionFactor": "4",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * mb),
        "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    }
