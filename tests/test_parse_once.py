"""A record is parsed once for all that is asked of it."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions.scalars import once
from ledgerflow.operators.infer import infer_schema
from ledgerflow.operators.load import incremental_filter, rejected_records
from ledgerflow.sources.records import records_from_json, records_from_python
from ledgerflow.spec import IncrementalSpec, JobSpec

JOB = JobSpec("depot", "grown", ("k",), IncrementalSpec("at", "2024-01-01T00:00:00", "%Y-%m-%dT%H:%M:%S"))
GOOD = {"k": 1, "at": "2024-01-02T03:04:05", "day": "2024-01-02", "n": 1, "x": 1.5}


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def texts(spark, n=4):
    rows = [(i, json.dumps({**GOOD, "k": i} if i % 2 else {**GOOD, "k": i, "n": "no"})) for i in range(n)]
    return spark.createDataFrame(rows, "ordinal long, text string")


def test_records_are_parsed_once_for_their_check(spark):
    """the filter on the problems moved below the check and repeated it for every mention."""
    schema = infer_schema(records_from_python(spark, [GOOD]), JOB, checkpoint=False)
    rejected = rejected_records(records_from_json(texts(spark)), schema, JOB)
    assert plan(rejected).count("parseJson") + plan(rejected).count("parse_json") == 1
    assert [(r["ordinal"], r["reasons"]) for r in rejected.orderBy("ordinal").collect()] == [
        (i, ["field 'n' is not integer but string"]) for i in (0, 2)]


def test_a_bound_parses_records_once_more(spark):
    """the bound's filter parsed the record for every mention of its key."""
    bound = JOB.incremental.resume(None)
    kept = incremental_filter(records_from_json(texts(spark)), JOB, bound)
    assert plan(kept).count("parseJson") + plan(kept).count("parse_json") == 2  # in the filter and for the column
    assert kept.count() == 4
    late = records_from_python(spark, [GOOD, {**GOOD, "at": "2023-12-31T23:59:59"}, {**GOOD, "at": None}])
    assert [r["ordinal"] for r in incremental_filter(late, JOB, bound).collect()] == [1]
    with pytest.raises(Exception, match="record 1: at does not match the job format: soon"):
        incremental_filter(records_from_python(spark, [{**GOOD, "at": "soon"}]), JOB, bound).collect()


def test_once_keeps_nulls(spark):
    got = spark.createDataFrame([(1,), (None,)], "v int").select(once(F.col("v") + 1, lambda v: F.coalesce(v * v, F.lit(-1))).alias("v"))
    assert sorted(r["v"] for r in got.collect()) == [-1, 4]
