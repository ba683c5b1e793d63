"""Inputs of few splits are spread before the heavy work per row."""

from pyspark.sql import functions as F

from ledgerflow.operators.infer import observe_records
from ledgerflow.session import spread_skinny


def test_few_splits_are_spread_by_size(spark):
    """a large input in few splits went to one share for each slot, however large."""
    cores = spark.sparkContext.defaultParallelism
    assert spread_skinny(spark.range(10, numPartitions=1)).rdd.getNumPartitions() == cores
    assert spread_skinny(spark.range(10_000_000, numPartitions=1)).rdd.getNumPartitions() == 4 * cores
    assert spread_skinny(spark.range(10, numPartitions=9 * cores)).rdd.getNumPartitions() == 9 * cores


def test_records_that_are_spread_are_not_spread_again(spark):
    """records are spread before they are made; inference must not shuffle them again."""
    raw = spread_skinny(spark.range(40, numPartitions=1))
    records = raw.select(F.col("id").alias("ordinal"), F.parse_json(F.concat(F.lit('{"k":'), "id", F.lit("}"))).alias("record"))
    assert spread_skinny(records) is records
    found = {"".join(r["path"]): r["n"] for r in observe_records(records, checkpoint=False).collect()}
    assert found == {"": 40, ".k": 40}
