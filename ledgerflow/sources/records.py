"""Record scans (S1-S9): landed JSON pages -> ``DataFrame[ordinal, record: variant]``.

Landing convention: files named with their page number (``...-<page>.json`` / ``.jsonl`` or
a ``page=<n>`` folder), optionally under one folder per extraction day. The ordinal of a
record is the struct (landed day, page, file, block, position): comparing two ordinals is
comparing when, in which page and where in it the records were extracted - a total order
over any number of pages and lines, computed per row with no driver listing, no global sort
and no bound on the size of a page. A file without a page number fails the read.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.scalars import split_nonempty

PAGE_PATTERN = r"(?:page=(\d+)/[^/]*|(\d+)\.jsonl?)$"  # page=<n>/file or ...<n>.json[l]


def page_number(path: Column) -> Column:
    """Page number from a landed file path: a ``page=<n>`` directory or ``...<n>.json``;
    any other path is an error, as its records would have no place in the order."""
    found = F.coalesce(
        F.nullif(F.regexp_extract(path, PAGE_PATTERN, 1), F.lit("")),
        F.nullif(F.regexp_extract(path, PAGE_PATTERN, 2), F.lit("")),
    ).cast("long")
    failed = F.raise_error(F.concat(F.lit("no page number in the landed file name "), path)).cast("long")
    return F.when(found.isNull(), failed).otherwise(found)


def _file() -> Column:
    # the file source's metadata column is deterministic (input_file_name() is not, and
    # would stop predicates from being pushed below this projection)
    return F.col("_metadata.file_path")


def ordinal(page: Column, pos: Column, file: Column | None = None, block: Column | None = None,
            landed: Column | None = None) -> Column:
    """A record's place in extraction order."""
    return F.struct(
        (F.lit(None) if landed is None else landed).cast("date").alias("landed"),
        page.cast("long").alias("page"),
        (F.lit("") if file is None else file).alias("file"),
        (F.lit(0) if block is None else block).cast("long").alias("block"),
        pos.cast("long").alias("pos"),
    )


def records_from_json(df: DataFrame, text: str = "text", ordinal_col: str = "ordinal") -> DataFrame:
    """Parse a column of JSON text into a variant ``record`` (invalid JSON fails)."""
    return df.select(F.col(ordinal_col).alias("ordinal"), F.parse_json(F.col(text)).alias("record"))


def records_from_python(spark: SparkSession, records: Iterable[Any]) -> DataFrame:
    """Small in-memory records (tests, fixtures): ordinals 1..n in the given order."""
    rows = [(i, json.dumps(r, default=str)) for i, r in enumerate(records, start=1)]
    df = spark.createDataFrame(rows, "ordinal long, text string")
    return records_from_json(df)


def located_lines(raw: DataFrame, landed_on: str | None = None) -> DataFrame:
    """Text lines with the file and the file block that each comes from (batch or stream)."""
    landed = [F.col(landed_on).cast("date").alias(landed_on)] if landed_on else []
    return raw.select("value", _file().alias("__file"), F.col("_metadata.file_block_start").alias("__block"), *landed)


def line_records(lines: DataFrame, landed_on: str | None = None) -> DataFrame:
    """Located lines -> records. Files are split like any text input: a record's position
    is the start of its file block, then its place in the block, which one task reads front
    to back."""
    placed = lines.withColumn("__pos", F.monotonically_increasing_id())
    placed = placed.where(F.trim(F.regexp_replace("value", "\r$", "")) != "")
    landed = [landed_on] if landed_on else []
    place = ordinal(page_number(F.col("__file")), F.col("__pos"), F.col("__file"), F.col("__block"), *map(F.col, landed))
    return placed.select(place.alias("ordinal"), F.parse_json("value").alias("record"), *landed)


def read_json_lines(spark: SparkSession, path: str, landed_on: str | None = None,
                    landed_since: date | None = None) -> DataFrame:
    """JSON-lines pages: each line a record (S1). With ``landed_on`` the landing area is
    partitioned by extraction day (``<path>/<landed_on>=YYYY-MM-DD/...``), the day leads the
    order and the column is kept; ``landed_since`` then reads only the folders of that day
    and later."""
    raw = spark.read.text(path)
    if landed_on and landed_since:
        raw = raw.where(F.col(landed_on) >= F.lit(landed_since.isoformat()).cast("date"))
    return line_records(located_lines(raw, landed_on), landed_on)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Whole-page JSON documents (an envelope object or a bare array), one per file: the
    document is the unit of the API's answer, so its size is the API's page size."""
    return spark.read.text(path, wholetext=True).select(
        page_number(_file()).alias("page"), _file().alias("file"), F.parse_json("value").alias("page_doc")
    )


def unnest_pages(pages: DataFrame, envelope: str | None, drop: Sequence[str] = ()) -> DataFrame:
    """Envelope unnest (S2-S7): ``data`` / ``results`` / ``changes`` / ``items`` /
    ``records`` arrays, or a bare array when ``envelope`` is None (S4). Position in the
    page gives the ordinal, so the change-feed commit order is kept (S5). ``drop`` removes
    per-row keys such as ``links`` or ``attributes``."""
    arr = F.col("page_doc") if envelope is None else F.expr(f"page_doc:{envelope}")
    file = F.col("file") if "file" in pages.columns else F.lit("")
    rows = pages.select("page", file.alias("file"), F.posexplode(_as_array(arr)).alias("pos", "record"))
    out = rows.select(ordinal(F.col("page"), F.col("pos"), F.col("file")).alias("ordinal"), "record")
    if drop:
        out = out.withColumn("record", drop_keys(F.col("record"), drop))
    return out


def _as_array(v: Column) -> Column:
    return v.cast("array<variant>")


def drop_keys(record: Column, keys: Sequence[str]) -> Column:
    """Remove top-level keys from a variant object."""
    as_map = record.cast("map<string,variant>")
    kept = F.map_filter(as_map, lambda k, _v: ~k.isin(*keys))
    return F.to_variant_object(kept)


def require_objects(records: DataFrame) -> DataFrame:
    """Object-only guard (S1): fail on the first record that is not a JSON object."""
    bad = F.col("record").isNull() | ~F.schema_of_variant("record").startswith("OBJECT")
    return records.withColumn(
        "record",
        F.when(
            bad,
            F.raise_error(F.concat(F.lit("record ordinal "), F.col("ordinal").cast("string"),
                                   F.lit(" is not a JSON object"))),
        ).otherwise(F.col("record")),
    )


def flatten_geojson(features: DataFrame) -> DataFrame:
    """GeoJSON feature -> flat record (S8, C18, C21, C22): ``properties`` spread to the
    top level with ``id``; coordinates become longitude / latitude / depth_km; epoch
    millis become ISO strings with milliseconds; ``,a,b,`` lists become arrays."""
    coords = F.expr("record:geometry.coordinates").cast("array<double>")
    p = F.expr("record:properties").cast("map<string,variant>")

    def iso_millis(key: str) -> Column:
        ms = F.expr(f"record:properties.{key}").cast("long")
        return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSSxxx")

    def csv_list(key: str) -> Column:
        return split_nonempty(F.expr(f"record:properties.{key}").cast("string"), ",").cast("variant")

    replaced = F.map_concat(
        F.map_filter(p, lambda k, _v: ~k.isin("time", "updated", "ids", "sources", "types")),
        F.create_map(
            F.lit("id"), F.expr("record:id"),
            F.lit("time"), iso_millis("time").cast("variant"),
            F.lit("updated"), iso_millis("updated").cast("variant"),
            F.lit("ids"), csv_list("ids"),
            F.lit("sources"), csv_list("sources"),
            F.lit("types"), csv_list("types"),
            F.lit("longitude"), F.element_at(coords, 1).cast("variant"),
            F.lit("latitude"), F.element_at(coords, 2).cast("variant"),
            F.lit("depth_km"), F.element_at(coords, 3).cast("variant"),
        ),
    )
    return features.select("ordinal", F.to_variant_object(replaced).alias("record"))


def describe_columns(describe: DataFrame, compound_types: Sequence[str] = ("address", "location")) -> list[str]:
    """Metadata-driven column list (S9): every described field except compound types.
    The describe document has one row per field (name, type); it is tiny."""
    rows = describe.filter(~F.col("type").isin(*compound_types)).select("name").collect()
    return [r["name"] for r in rows]
