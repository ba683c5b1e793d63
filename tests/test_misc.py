import tempfile

from pyspark.sql import functions as F

from helpers import frame
from ledgerflow.functions.measures import MEASURES, base_measures, slug
from ledgerflow.functions.scalars import split_nonempty, strptime_to_spark
from ledgerflow.operators.quality import uncategorized_items
from ledgerflow.plans import models
from ledgerflow.plans.pages import slicer_values, top_n
from ledgerflow.session import scale_conf
from ledgerflow.sources.records import describe_columns


def test_describe_driven_columns(spark):
    d = spark.createDataFrame([("Id", "id"), ("Name", "string"), ("MailingAddress", "address")], "name string, type string")
    assert describe_columns(d) == ["Id", "Name"]


def test_uncategorized_items_report(spark):
    e = frame(spark, [{"item_name": "Misc", "category_code": "unmapped", "hours": 1.5},
                      {"item_name": "Misc", "category_code": "unmapped", "hours": 2},
                      {"item_name": "Admin", "category_code": "internal_admin", "hours": 1}],
              "item_name string, category_code string, hours decimal(8,2)")
    r = uncategorized_items(e).collect()
    assert [(x.item_name, x.entries, float(x.hours)) for x in r] == [("Misc", 2, 3.5)]


def test_strptime_translation_and_split():
    assert strptime_to_spark("%Y-%m-%dT%H:%M:%S.%f%z") == "yyyy-MM-dd'T'HH:mm:ss.SSSSSSZ"
    assert strptime_to_spark("%m/%d/%Y %H:%M") == "MM/dd/yyyy HH:mm"


def test_split_nonempty(spark):
    row = spark.range(1).select(split_nonempty(F.lit(",a,,b,"), ",").alias("x"), split_nonempty(F.lit(""), ";").alias("y")).collect()[0]
    assert row.x == ["a", "b"] and row.y == []


def test_measure_registry():
    assert slug("Net Utilization %") == "net_utilization_pct"
    assert [m.name for m in base_measures(["Internal %"])] == ["Internal Productive Hours", "Internal Admin Hours", "Expected Hours"]
    assert {m.fact for m in MEASURES.values() if m.is_base} == {"time_entries", "capacity", "project_margin"}


def test_slicer_values_and_top_n(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 3.0), ("b", 2.0)], "name string, h double")
    assert [r.name for r in slicer_values(df, "name").collect()] == ["a", "b"]
    assert [r.h for r in top_n(df, "h", 2).collect()] == [3.0, 2.0]


def test_publish_views_and_tables(spark):
    df = spark.createDataFrame([(1,)], "x int")
    out = tempfile.mkdtemp(prefix="pub-", dir="/tmp")
    models.publish({"rpt_demo": df}, write_to=out)
    assert spark.table("rpt_demo").count() == 1
    assert spark.read.parquet(f"{out}/rpt_demo").count() == 1


def test_scale_conf_sizes_partitions():
    conf = scale_conf(100 * 1024 ** 4, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 204800  # 512 MB of input each
    assert int(scale_conf(10 * 1024 ** 3, 64)["spark.sql.shuffle.partitions"]) == 128
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_bi_model_resolves_every_measure_and_relationship(spark):
    """Consistency of the star (as the BI model test does): every base measure's column
    exists on its fact, every derived measure resolves to base measures, and every
    relationship's fact column and dimension key exist on the frames built from the
    driver tables."""
    from ledgerflow.plans import pages, reporting
    from ledgerflow.plans.standins import StandIns

    s = StandIns(spark, "/root/testdata/sf0.001")
    facts = {
        "time_entries": s.categorized,
        "capacity": s.capacity,
        "project_margin": reporting.project_margin(s.dim_project, s.financial_lines, s.categorized),
    }
    dims = {"date": s.dim_date, "employee": s.dim_employee, "client": s.dim_client,
            "project": s.dim_project, "item": s.dim_item}
    for m in MEASURES.values():
        if m.is_base:
            assert m.column in facts[m.fact].columns, m.name
        else:
            assert all(i in MEASURES for i in m.inputs), m.name
            assert base_measures([m.name]), m.name
    for fact, fcol, dim, key in pages.RELATIONSHIPS:
        assert fcol in facts[fact].columns, (fact, fcol)
        assert key in dims[dim].columns, (dim, key)
    # every dimension key is unique (many-to-one relationships)
    for dim, key in {(d, k) for _, _, d, k in pages.RELATIONSHIPS}:
        df = dims[dim]
        assert df.groupBy(key).count().filter("count > 1").count() == 0, dim


def test_cluster_and_local_coalescing_settings(spark):
    conf = scale_conf(100 * 1024 ** 4, 8000)
    assert conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
    assert float(conf["spark.sql.sources.fileCompressionFactor"]) > 1
    # the test session is a local master: Spark's parallelism-first default
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.parallelismFirst") == "true"
