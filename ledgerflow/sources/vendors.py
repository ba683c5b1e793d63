"""Per-vendor extracts over landed pages (S14-S20), registered by job name (G1).

Each function reads the pages one vendor's API returned (one file per page under
``<landing>/<job>/``) and yields ``ordinal, record``; the incremental bound is applied
by the load (``incremental_filter``), per-job options become filters (G6).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.sources import plugin
from ledgerflow.sources.catalog import SourceRegistry
from ledgerflow.sources.records import flatten_geojson, read_pages, unnest_pages
from ledgerflow.spec import JobSpec

REGISTRY = SourceRegistry()

# Each vendor's page envelope and the per-row keys it drops.
ENVELOPES = {
    "shopfront": ("data", ()),
    "cartwheel": ("results", ()),
    "ticketdesk": (None, ()),
    "helpline": ("changes", ()),
    "netsuite": ("items", ("links",)),
    "salesforce": ("records", ("attributes",)),
    "usgs": ("features", ()),
}


def _pages(spark: SparkSession, landing: str, consumer: str, spec: JobSpec) -> DataFrame:
    envelope, drop = ENVELOPES[consumer]
    return unnest_pages(read_pages(spark, f"{landing.rstrip('/')}/{spec.name}"), envelope, drop)


def _register(consumer: str, jobs: list[str]) -> None:
    for job in jobs:
        def fetch(spark: SparkSession, landing: str, spec: JobSpec, _c: str = consumer) -> DataFrame:
            return _pages(spark, landing, _c, spec)

        REGISTRY.register(consumer, f"fetch_{job}")(fetch)


_register("shopfront", ["customers", "orders"])  # S14
_register("ticketdesk", ["tickets", "agents"])  # S16
_register("helpline", ["cases", "staff"])  # S17 (change feed order = page, position)
_register("salesforce", ["contacts", "accounts", "opportunities"])  # S18
_register("netsuite", ["customers", "transactions", "departments", "employees", "projects", "items",
                       "time_entries", "transaction_lines", "transaction_accounting_lines", "accounts"])  # S19


def _cartwheel(spark: SparkSession, landing: str, spec: JobSpec) -> DataFrame:
    """Soft-deleted rows are included (F5); the flag travels downstream."""
    recs = _pages(spark, landing, "cartwheel", spec)
    if not spec.options.get("include_deleted", True):
        recs = recs.filter(~F.coalesce(F.variant_get("record", "$.isDeleted", "boolean"), F.lit(False)))
    return recs


for _job in ("customers", "orders", "order_items"):
    REGISTRY.register("cartwheel", f"fetch_{_job}")(_cartwheel)


def usgs_predicate(options: dict) -> Column:
    """Per-job options of the earthquake feed as one predicate over flattened features
    (G6): ``minmagnitude`` / ``minsig`` / ``starttime`` (inclusive)."""
    cond = F.lit(True)
    if "minmagnitude" in options:
        cond = cond & (F.variant_get("record", "$.mag", "double") >= F.lit(float(options["minmagnitude"])))
    if "minsig" in options:
        cond = cond & (F.variant_get("record", "$.sig", "bigint") >= F.lit(int(options["minsig"])))
    if "starttime" in options:
        t = F.variant_get("record", "$.time", "string").try_cast("timestamp")
        cond = cond & (t >= F.lit(options["starttime"]).cast("timestamp"))
    return F.coalesce(cond, F.lit(False))


def usgs_options(flat: DataFrame, options: dict) -> DataFrame:
    return flat.filter(usgs_predicate(options))


def _usgs(spark: SparkSession, landing: str, spec: JobSpec) -> DataFrame:
    """GeoJSON features flattened; the same scan serves both jobs, with per-job
    options as filters."""
    return usgs_options(flatten_geojson(_pages(spark, landing, "usgs", spec)), spec.options)


REGISTRY.register("usgs", "fetch_earthquakes")(_usgs)
REGISTRY.register("usgs", "fetch_significant_earthquakes")(_usgs)


def read_records(spark: SparkSession, path: str, spec: JobSpec) -> DataFrame:
    """The records of a job's landing area (S1-S20): ``ordinal, record`` from the job's
    source function, resolved by name in the registry (G1), with its options (G6)."""
    return REGISTRY.fetch(spark, spec.consumer, path, spec)


def _plugged(reader, landing: str, spec: JobSpec, options: dict[str, str]) -> DataFrame:
    envelope, drop = ENVELOPES[spec.consumer]
    if envelope:
        options = options | {"envelope": envelope}
    pages = reader.format(plugin.FORMAT).options(**options).load(f"{landing.rstrip('/')}/{spec.name}")
    return plugin.page_records(pages, drop)


def load_pages(spark: SparkSession, landing: str, spec: JobSpec, **options: str) -> DataFrame:
    """The records of a vendor's landing area through the data source of :mod:`plugin`, which
    cuts pages of any size into records while it reads them."""
    plugin.register(spark)
    return _plugged(spark.read, landing, spec, options)


def stream_pages(spark: SparkSession, landing: str, spec: JobSpec, **options: str) -> DataFrame:
    """The same as a stream: pages that land later come in later micro-batches."""
    plugin.register(spark)
    return _plugged(spark.readStream, landing, spec, options)
