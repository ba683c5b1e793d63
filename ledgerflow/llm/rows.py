"""Row-wise Python inside tasks over Arrow batches: exact 64-bit ids and NULLs, one row in
memory as Python objects at a time, output in bounded batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_OUT = 512


def map_stream(df: DataFrame, run: Callable[[Iterator[tuple]], Iterator[list[tuple]]], schema: str) -> DataFrame:
    """``run`` turns a task's rows (tuples in column order) into lists of output rows."""
    fields = T.StructType.fromDDL(schema)

    def batches(incoming):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(fields)

        def rows():
            for batch in incoming:
                for values in zip(*batch.columns):
                    yield tuple(v.as_py() for v in values)

        for out in run(rows()):
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, type=f.type) for column, f in zip(zip(*out), target)], schema=target)

    return df.mapInArrow(batches, fields)


def map_rows(df: DataFrame, make: Callable[[], Callable[..., tuple]], schema: str) -> DataFrame:
    """One output row per row; ``make`` builds the per-row function once per task."""

    def run(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        one = make()
        return in_lists(one(*row) for row in rows)

    return map_stream(df, run, schema)


def in_lists(rows: Iterable[tuple], most: int = ROWS_OUT) -> Iterator[list[tuple]]:
    """Output rows in lists of bounded length."""
    out = []
    for row in rows:
        out.append(row)
        if len(out) >= most:
            yield out
            out = []
    yield out


def id_and_text(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(id long, text string), NULL texts empty."""
    return docs.select(docs[key].cast("long").alias("id"), F.coalesce(docs[text], F.lit("")).alias("text"))


def id_and_bytes(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(id long, text as UTF-8 bytes), NULL texts empty."""
    return id_and_text(docs, text, key).withColumn("text", F.col("text").cast("binary"))
