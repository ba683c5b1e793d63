"""Seed reference tables.

Seeds are small, fixed-size lookup tables: they are safe to broadcast because their size
is bounded by construction, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME_CATEGORIES_SCHEMA = T.StructType(
    [
        T.StructField("item_name", T.StringType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("category_name", T.StringType()),
        T.StructField("counts_as_worked", T.BooleanType()),
        T.StructField("is_client_facing", T.BooleanType()),
    ]
)
ACCOUNT_CLASSES_SCHEMA = T.StructType(
    [
        T.StructField("account_number", T.StringType()),
        T.StructField("account_class", T.StringType()),
        T.StructField("note", T.StringType()),
    ]
)
DEPARTMENT_GROUPS_SCHEMA = T.StructType(
    [
        T.StructField("department_name", T.StringType()),
        T.StructField("group_name", T.StringType()),
    ]
)

# The time-category seed (item name -> category; worked; client facing).
TIME_CATEGORIES = [
    ("Project Time", "project_work", "Project Work", True, True),
    ("Business Development", "client_bd", "Client - BD", True, True),
    ("RFP Response/Proposal Development", "client_bd", "Client - BD", True, True),
    ("Marketing/Design", "client_bd", "Client - BD", True, True),
    ("Client and/or Team Strategy/Planning/Meeting", "internal_productive", "Internal - Productive", True, False),
    ("Training", "internal_productive", "Internal - Productive", True, False),
    ("Staffing/Resource Management", "internal_productive", "Internal - Productive", True, False),
    ("Continuing Education/Professional Development", "internal_productive", "Internal - Productive", True, False),
    ("Innovation/Methods Development", "internal_productive", "Internal - Productive", True, False),
    ("Admin", "internal_admin", "Internal - Admin", True, False),
    ("Meeting", "internal_admin", "Internal - Admin", True, False),
    ("Travel (Business Development)", "internal_admin", "Internal - Admin", True, False),
    ("Travel (Corporate)", "internal_admin", "Internal - Admin", True, False),
    ("Holiday", "exempt", "Exempt", False, False),
    ("PTO/Personal Leave/Birthday", "exempt", "Exempt", False, False),
    ("Volunteer", "exempt", "Exempt", False, False),
    ("Jury Duty", "exempt", "Exempt", False, False),
    ("Bereavement", "exempt", "Exempt", False, False),
    ("FMLA", "exempt", "Exempt", False, False),
]

# Account number -> margin class.
ACCOUNT_CLASSES = [
    ("32000", "excluded", "Opening balances are not project activity"),
    ("40000", "revenue", "Research revenue"),
    ("40110", "pass_through_travel", "Travel billed to the client at cost"),
    ("40120", "pass_through_incentive", "Respondent incentives billed to the client at cost"),
    ("50100", "field_cost", "COG research services"),
    ("50200", "field_cost", "COG field services"),
    ("50300", "incentive_cost", "COG respondent incentives"),
    ("50400", "travel_cost", "COG travel"),
]

# Department -> reporting group.
DEPARTMENT_GROUPS = [
    ("Consumer Group", "Account Team"),
    ("Life Sciences", "Account Team"),
    ("Technology Group", "Account Team"),
    ("Operations", "Operations"),
    ("Special Services", "Special Services"),
    ("Admin", "Admin"),
]

# Accepted category codes (checked by the accepted_values test on the seed).
CATEGORY_CODES = ("project_work", "client_bd", "internal_productive", "internal_admin", "exempt")
ACCOUNT_CLASS_CODES = (
    "excluded",
    "revenue",
    "pass_through_travel",
    "pass_through_incentive",
    "field_cost",
    "incentive_cost",
    "travel_cost",
)


def literal(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """Fixed rows as a local relation, whose size the planner knows - also behind a join,
    where a broadcast hint is gone."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(T._parse_datatype_string(schema) if isinstance(schema, str) else schema)
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(kinds.names, r, strict=True)) for r in rows], schema=kinds))


def time_categories(spark: SparkSession) -> DataFrame:
    return literal(spark, TIME_CATEGORIES, TIME_CATEGORIES_SCHEMA)


def account_classes(spark: SparkSession) -> DataFrame:
    return literal(spark, ACCOUNT_CLASSES, ACCOUNT_CLASSES_SCHEMA)


def department_groups(spark: SparkSession) -> DataFrame:
    return literal(spark, DEPARTMENT_GROUPS, DEPARTMENT_GROUPS_SCHEMA)


def read_seed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Seed CSV with a header and declared column types (no inference).

    Malformed rows fail the read (``FAILFAST``) instead of turning into NULLs.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("escape", '"')  # a quote inside quotes is doubled
        .csv(path)
    )


def bounded(df: DataFrame) -> DataFrame:
    """Mark a frame whose size is bounded by construction (seed, literal map, one-row
    aggregate) for broadcast. Never call this on a frame that grows with the data."""
    return F.broadcast(df)
