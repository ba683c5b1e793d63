"""Landed records as Parquet with a typed incremental key.

A bound on a key inside a JSON record can only be checked after the record is parsed. Landed
this way, the key stands beside the record as a number (microseconds since 1970, UTC), rows
are sorted by it in every file, and a bound reaches the scan as a plain comparison: row
groups whose statistics lie below it are skipped and their records are never read.

A key that is there but does not parse is kept as text in a column of its own: such a row
passes every bound and fails the read, as it would fail in the record. Rows without a key
have neither, and no bounded read returns them. Late records are found by their key, in
whichever landing they came.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.scalars import parse_instant
from ledgerflow.spec import IncrementalSpec, JobSpec

KEY, UNREAD = "__key_micros", "__key_unread"


def _key(record: Column, inc: IncrementalSpec) -> tuple[Column, Column]:
    """The record's key in microseconds, and its text."""
    value = record.cast("map<string,variant>")[inc.key]
    text = F.try_variant_get(value, "$", "string")
    if inc.clock.pattern is None:
        return F.try_variant_get(value, "$", "long") * F.lit(1_000_000), text
    return F.unix_micros(parse_instant(text, inc.clock.pattern)), text


def land(records: DataFrame, spec: JobSpec, path: str, landing: str) -> None:
    """Write one landing (a day, a batch) of ``records``; the same landing again replaces
    itself. Sorting is within a task: no record moves."""
    if spec.incremental is None:
        raise ValueError(f"{spec}: a job without an incremental key has no bound to push down")
    key, text = _key(F.col("record"), spec.incremental)
    rows = records.withColumn(KEY, key).withColumn(UNREAD, F.when(F.col(KEY).isNull(), text))
    rows.sortWithinPartitions(KEY).withColumn("landing", F.lit(landing)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("landing").parquet(path)


@dataclass(frozen=True)
class Landed:
    """A landing area written by :func:`land`."""

    path: str

    def since(self, spark: SparkSession, spec: JobSpec, bound: datetime | None, exclusive_source: bool = False) -> DataFrame:
        """The records at or after ``bound`` (all without one): ``ordinal, record``."""
        rows = spark.read.parquet(self.path)
        if bound is not None:
            micros = int((bound.astimezone(UTC) - datetime(1970, 1, 1, tzinfo=UTC)).total_seconds() * 1_000_000)
            after = F.col(KEY) > F.lit(micros - 1_000_000) if exclusive_source else F.col(KEY) >= F.lit(micros)
            # the first condition is for the scan; the second fails on what the first let pass
            rows = rows.where(after | F.col(UNREAD).isNotNull())
            failed = F.raise_error(F.concat(F.lit("record "), F.col("ordinal").cast("string"),
                                            F.lit(f": {spec.incremental.key} does not match the job format: "), F.col(UNREAD)))
            rows = rows.where(F.when(F.col(UNREAD).isNotNull(), failed.cast("boolean")).otherwise(after))
        return rows.select("ordinal", "record")
