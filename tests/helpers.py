from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def frame(spark: SparkSession, rows: list[dict], ddl: str) -> DataFrame:
    """Rows given as dicts (missing keys are NULL) against a DDL schema; numbers are
    converted to the declared decimal / date types."""
    schema = T._parse_datatype_string(ddl)
    import datetime as dt

    def conv(v, t):
        if v is None:
            return None
        if isinstance(t, T.DecimalType):
            return Decimal(str(v))
        if isinstance(t, T.DateType) and isinstance(v, str):
            return dt.date.fromisoformat(v)
        return v

    data = [tuple(conv(r.get(f.name), f.dataType) for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema)


def as_float(v):
    return None if v is None else float(v)
