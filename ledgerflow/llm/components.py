"""Connected components of an undirected edge table, on Spark.

Alternating "large star / small star" rounds: every node links its larger neighbours (then
its smaller ones) to the smallest node it knows. Each round is a partial-aggregate minimum
and one equi-join, so a hub's edges never meet in one task; rounds are written to the
shared checkpoint folder, which cuts the lineage and survives lost executors. The number of
rounds grows with the logarithm of the component size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (a, b) distinct; returns (a, b) with a > b."""
    if large:
        near = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.col("n")).alias("m"))
    joined = near.join(least, near["a"] == least["n"]).select("a", "b", "m")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").union(
            least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    return moved.where("a != b").distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """(node, root): the smallest node of its component for every node that has a link.

    NULL ends and self links are ignored; repeated links count once; an empty table gives
    an empty result. Raises when the rounds do not converge within ``max_rounds``."""
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a != b")
    edges = materialize(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-edges")
    before = None
    for _ in range(max_rounds):
        edges = materialize(_star(_star(edges, True), False), "cc-round")
        seen = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
        ).first()
        if (seen["n"], seen["h"]) == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = (seen["n"], seen["h"])
    raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")
