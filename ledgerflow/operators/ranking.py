"""Distributed rank.

``rank() OVER ([PARTITION BY g] ORDER BY ...)`` moves every row of a partition (or,
without one, every row) into one task. Here:

1. rows collapse to their distinct (group, ordering key) with a count (a partial+final
   aggregate), so a value shared by a third of all rows becomes one row before any sort;
2. the distinct keys are range-partitioned on (group, ordering), so a group holding a
   third of all keys still spreads over many partitions; each key's rank is
   1 + (rows of its group with a greater key in its own range partition) + (rows of its
   group in earlier range partitions), the latter from a table with one row per
   (range partition, group) - at most (#groups + #partitions) rows;
3. ranks join back to the rows on (group, key) (null-safe); a hot key there is one row
   on the small side, which the planner broadcasts when small or AQE splits when skewed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.session import materialize


def _order(col: str, descending: bool, nulls_first: bool) -> Column:
    c = F.col(col)
    if descending:
        return c.desc_nulls_first() if nulls_first else c.desc_nulls_last()
    return c.asc_nulls_first() if nulls_first else c.asc_nulls_last()


def _stage_reuse(spark) -> bool:
    """True when AQE materializes an exchange once for every branch that reads it."""
    conf = spark.conf
    return (conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
            and conf.get("spark.sql.exchange.reuse", "true").lower() == "true")


def global_rank(
    df: DataFrame,
    columns: Sequence[str],
    descending: bool = True,
    nulls_first: bool = False,
    name: str = "rank",
    num_partitions: int | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Add ``name`` = SQL ``rank()`` over ``partition_by`` (default: the whole frame)
    ordered by ``columns`` (all descending or all ascending). Ties share a rank and the
    next rank skips; NULL groups form one group each, as in SQL."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = list(partition_by)
    order = [_order(c, descending, nulls_first) for c in columns]
    keys = df.groupBy(*groups, *columns).agg(F.count(F.lit(1)).alias("__n"))
    ranged = keys.repartitionByRange(n, *[F.col(g).asc_nulls_first() for g in groups], *order).withColumn(
        "__pid", F.spark_partition_id()
    )
    if not _stage_reuse(spark):
        # both branches below must see the same range bounds; the bounds come from a
        # sample of the keys, so without AQE's stage reuse the keys are written once
        ranged = materialize(ranged, "rank-keys")
    before_local = F.coalesce(
        F.sum("__n").over(
            Window.partitionBy("__pid", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    local = ranged.withColumn("__before", before_local)
    offsets = (
        ranged.groupBy("__pid", *groups)
        .agg(F.sum("__n").alias("__size"))
        .withColumn(
            "__offset",
            F.coalesce(
                F.sum("__size").over(
                    Window.partitionBy(*groups).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .select(F.col("__pid").alias("__opid"), *[F.col(g).alias(f"__o_{g}") for g in groups], "__offset")
    )
    on = F.col("__pid") == F.col("__opid")
    for g in groups:
        on = on & F.col(g).eqNullSafe(F.col(f"__o_{g}"))
    # without groups the offsets have one row per range partition: bounded by ``n``
    offsets = offsets if groups else F.broadcast(offsets)
    ranked_keys = local.join(offsets, on).select(
        *[F.col(c).alias(f"__k_{c}") for c in [*groups, *columns]],
        (F.col("__offset") + F.col("__before") + F.lit(1)).cast("int").alias(name),
    )
    cond = None
    for c in [*groups, *columns]:
        eq = F.col(c).eqNullSafe(F.col(f"__k_{c}"))
        cond = eq if cond is None else cond & eq
    return df.join(ranked_keys, cond, "inner").drop(*[f"__k_{c}" for c in [*groups, *columns]])
