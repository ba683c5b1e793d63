"""Interval join by bins (J5): points that lie in intervals, without a nested loop.

Both sides are cut into bins of a fixed width, joined on the bin by an ordinary equi-join -
which Spark broadcasts, shuffles or splits by its own measures - and the exact condition
decides within the bin. A point lies in one bin, so no pair comes twice; an interval is in as
many bins as it spans of the points' own range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def interval_join(points: DataFrame, intervals: DataFrame, at: Column, since: Column, until: Column, width: int) -> DataFrame:
    """All columns of both sides, a row per point and interval with ``since <= at`` and
    (``until`` is NULL or ``at <= until``).

    ``at`` is a whole number of a point, ``since`` and ``until`` of an interval; ``width``
    is that of a bin (about as wide as intervals are apart, or several points). A NULL
    ``at`` or ``since`` matches nothing. Column names of the sides must differ."""
    if width < 1:
        raise ValueError("a bin must be at least 1 wide")

    def bin_of(c: Column) -> Column:
        return F.floor(c.cast("long") / F.lit(width)).cast("long")

    ends = points.agg(F.struct(F.min(at).cast("long").alias("first"), F.max(at).cast("long").alias("last"))).scalar()
    # one subquery for both ends, and none of the bins that no point can lie in
    spans = intervals.withColumn("__ends", ends).withColumn("__from", since.cast("long")).withColumn("__to", until.cast("long"))
    spans = spans.withColumn("__first", F.greatest("__from", "__ends.first")).withColumn(
        "__last", F.least("__to", "__ends.last"))  # greatest and least skip NULLs
    spans = spans.where(F.col("__from").isNotNull() & (F.col("__first") <= F.col("__last")))
    spans = spans.withColumn("__bin", F.explode(F.sequence(bin_of(F.col("__first")), bin_of(F.col("__last")))))
    placed = points.withColumn("__at", at.cast("long")).where(F.col("__at").isNotNull()).withColumn("__point_bin", bin_of(F.col("__at")))
    joined = placed.join(spans, (F.col("__point_bin") == F.col("__bin")) & (F.col("__at") >= F.col("__from"))
                         & (F.col("__to").isNull() | (F.col("__at") <= F.col("__to"))))
    return joined.select(*[placed[c] for c in points.columns], *[spans[c] for c in intervals.columns])
