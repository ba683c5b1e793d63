"""Catalog, schema files and the source registry.

The catalog maps a logical source name to a storage path (S11); schema files are small
JSON documents written from the driver after the distributed inference (K5) and read
back with a clear error when absent (S12).
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators.infer import (
    InferenceError,
    InferredSchema,
    job_patterns,
    merge_observations,
    observe_records,
    resolve_schema,
)
from ledgerflow.spec import JobSpec


@dataclass
class Catalog:
    """Logical name -> Parquet path (S11). ``schema`` plays the role of the warehouse
    schema variable: names resolve under ``<root>/<schema>/<name>``."""

    root: str
    schema: str = "raw"
    overrides: dict[str, str] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return self.overrides.get(name) or f"{self.root.rstrip('/')}/{self.schema}/{name}"

    def source(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.path(name))


def schema_path(root: str, consumer: str, job: str) -> str:
    return f"{root.rstrip('/')}/schemas/{consumer}/{job}.json"


def write_schema(spark: SparkSession, schema: InferredSchema, root: str) -> str:
    """K5: one JSON document per job, written as a single text file through Spark (so
    any Hadoop-compatible path works)."""
    path = schema_path(root, schema.consumer, schema.job)
    spark.createDataFrame([(json.dumps(schema.to_json()),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)
    return path


def read_schema(spark: SparkSession, root: str, consumer: str, job: str) -> InferredSchema:
    """The saved schema of (consumer, job); a clear error when it was never inferred."""
    path = schema_path(root, consumer, job)
    try:
        rows = spark.read.text(path).collect()
    except Exception as exc:  # noqa: BLE001 - path missing
        raise InferenceError(f"no schema at {path}; run inference for {consumer}.{job} first") from exc
    if not rows:
        raise InferenceError(f"no schema at {path}; run inference for {consumer}.{job} first")
    return InferredSchema.from_json(json.loads("".join(r["value"] for r in rows)))


# --- statistics saved with the schema -----------------------------------------------------

def observations_path(root: str, consumer: str, job: str) -> str:
    return f"{root.rstrip('/')}/schemas/{consumer}/{job}.observed"


def read_observations(spark: SparkSession, root: str, consumer: str, job: str) -> DataFrame:
    """The statistics of all landings saved so far, merged."""
    saved = spark.read.parquet(observations_path(root, consumer, job)).where("n > 0")
    return merge_observations(saved.drop("landing"))


def update_schema(spark: SparkSession, records: DataFrame, spec: JobSpec, root: str, landing: str) -> InferredSchema:
    """The schema after one more landing (a day, a batch): only its ``records`` are read;
    their statistics are saved beside those of the landings before, and the schema of all of
    them is resolved and written. A landing that is observed again replaces itself.

    A landing that does not fit fails with the first conflicting record's place and leaves
    the written schema as it was; its statistics stay saved, so that the conflict report can
    be read, until the landing is observed again or taken back (:func:`drop_landing`). Ordinals
    must be comparable across landings."""
    path = observations_path(root, spec.consumer, spec.name)
    observed = observe_records(records, job_patterns(spec)).withColumn("landing", F.lit(landing))
    observed.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("landing").parquet(path)
    schema = resolve_schema(read_observations(spark, root, spec.consumer, spec.name), spec)
    write_schema(spark, schema, root)
    return schema


def drop_landing(spark: SparkSession, spec: JobSpec, root: str, landing: str) -> None:
    """Take one landing's statistics back: it is replaced by an empty one."""
    path = observations_path(root, spec.consumer, spec.name)
    kept = spark.read.parquet(path).where(F.col("landing") == landing).withColumn("n", F.lit(0).cast("long"))
    rows = kept.collect()  # one row per path and class
    if rows:
        spark.createDataFrame(rows, kept.schema).coalesce(1).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("landing").parquet(path)


# --- source registry (G1) --------------------------------------------------------------

Fetch = Callable[[SparkSession, str, JobSpec], DataFrame]


class SourceRegistry:
    """``fetch_<job>`` functions per consumer, resolved by name; a job may override the
    name (``JobSpec.fetch``); a missing name lists the available ones."""

    def __init__(self) -> None:
        self._fns: dict[str, dict[str, Fetch]] = {}

    def register(self, consumer: str, name: str | None = None):
        def deco(fn: Fetch) -> Fetch:
            self._fns.setdefault(consumer, {})[name or fn.__name__] = fn
            return fn

        return deco

    def resolve(self, consumer: str, spec: JobSpec) -> Fetch:
        fns, wanted = self._fns.get(consumer, {}), spec.fetch or f"fetch_{spec.name}"
        if wanted not in fns:
            raise KeyError(f"{consumer}: no source function {wanted}; available: {', '.join(sorted(fns)) or 'none'}")
        return fns[wanted]

    def fetch(self, spark: SparkSession, consumer: str, landing: str, spec: JobSpec) -> DataFrame:
        return self.resolve(consumer, spec)(spark, landing, spec)


def render_columns(df: DataFrame, columns: dict[str, str], dates: tuple[str, ...] = ()) -> DataFrame:
    """An explicit column list with renames; date columns rendered as
    ``yyyy-MM-dd HH:mm:ss`` text, the way the ERP query language returns them."""
    out = []
    for src, name in columns.items():
        c = F.col(src)
        if src in dates:
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(name))
    return df.select(*out)
