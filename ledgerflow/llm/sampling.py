"""A bounded, repeatable sample of labelled rows for fitting small models."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.session import materialize

MOST_CLASSES = 500


def fold(key: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (a NULL id counts as empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts


def sample_per_class(rows: DataFrame, label: str, key: str, most: int, most_classes: int = MOST_CLASSES) -> DataFrame:
    """Of each class about ``most`` rows - all, if it has no more: those whose id hashes into
    the share that gives so many on average. Of more than ``most_classes`` classes those with
    the most rows are sampled (of equals the lesser label), with a warning.

    One narrow count per class finds the shares; the rows are then only filtered, never
    moved. Rows without an id or a label are never in the sample; rows that repeat an id
    are in it together."""
    rows = rows.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    counts = rows.groupBy(label).count().orderBy(F.desc("count"), label).limit(most_classes + 1).collect()
    if len(counts) > most_classes:
        warnings.warn(f"{label} has more than {most_classes} values: only the most frequent are learnt", stacklevel=2)
        counts = counts[:most_classes]
    if not counts:
        return rows
    # the hash is even over the 64-bit integers
    top = (1 << 63) - 1
    cuts = {r[0]: top if r[1] <= most else int(most / r[1] * 2.0 ** 64) - (1 << 63) for r in counts}
    cut = F.create_map(*[F.lit(x) for pair in cuts.items() for x in pair])[F.col(label)]
    return rows.where(F.xxhash64(F.col(key), F.lit("sample")) <= cut)


def sample_every_class(rows: DataFrame, label: str, key: str, most: int, at_least: int = 1) -> DataFrame:
    """As :func:`sample_per_class`, of every class with ``at_least`` rows, however many there
    are: only classes with more than ``most`` rows, or too few, have a share of their own,
    and those shares are a written table that the planner broadcasts if its size allows."""
    rows = rows.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    cut = rows.groupBy(F.col(label).alias("_class")).count().where((F.col("count") > most) | (F.col("count") < at_least))
    wide = F.expr(f"cast({float(most)}D / count * {2.0 ** 64}D as decimal(38,0)) - {1 << 63}BD")
    share = F.when(F.col("count") < at_least, F.lit(-(1 << 63))).otherwise(wide.cast("long"))
    cuts = materialize(cut.select("_class", share.alias("_cut")), "class-shares")
    joined = rows.join(cuts, F.col(label) == F.col("_class"), "left")
    kept = F.col("_cut").isNull() | (F.xxhash64(F.col(key), F.lit("sample")) < F.col("_cut"))
    return joined.where(kept).select(*[rows[c] for c in rows.columns])
