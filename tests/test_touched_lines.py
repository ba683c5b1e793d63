"""The financial lines of touched projects alone."""

from pyspark.sql import functions as F

from ledgerflow.plans import maintained
from ledgerflow.plans.standins import StandIns

SF = "/root/testdata/sf0.001"


def test_touched_financial_lines(spark):
    """the refresh joined the financial lines of all projects to keep those of a few."""
    s = StandIns(spark, SF)
    few = [r[0] for r in s.financial_lines.select("project_id").distinct().orderBy("project_id").limit(3).collect()]
    touched = spark.createDataFrame([(p,) for p in [*few, -1]], "project_id int")
    want = s.financial_lines.where(F.col("project_id").isin(few))
    got = s.financial_lines_on(touched)
    assert got.columns == want.columns and want.count() > 0
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert s.financial_lines_on(None) is s.financial_lines
    report = maintained.project_margin(s.dim_project, s.financial_lines_on, s.categorized)
    whole = report.build(None).where(F.col("project_id").isin(few))
    assert sorted(map(tuple, report.build(touched).collect())) == sorted(map(tuple, whole.collect()))
