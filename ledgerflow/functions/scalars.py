"""Column -> Column helpers (JVM-side built-ins only; no Python UDFs)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out a single time per row, however often ``use``
    names it. An expression that is named n times is otherwise written into the plan n times,
    and so is what it is made of: a few such steps on top of each other, or a filter that the
    optimizer moves below the column, multiply to hundreds of evaluations per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def flag(col: str | Column) -> Column:
    """Text flag 'T'/'F' -> boolean; anything else (incl. NULL) is false."""
    return F.coalesce(_c(col) == F.lit("T"), F.lit(False))


def week_start(day: str | Column) -> Column:
    """Sunday-start week: day minus its day-of-week (Sunday = 0)."""
    d = _c(day)
    return F.date_sub(d, F.dayofweek(d) - 1)


def is_weekday(day: str | Column) -> Column:
    """Monday..Friday (ISO day of week < 6)."""
    return ~F.dayofweek(_c(day)).isin(1, 7)


def regex_substring(col: str | Column, pattern: str, group: int = 1) -> Column:
    """SQL ``substring(x from pattern)``: the group, or NULL when there is no match."""
    return F.nullif(F.regexp_extract(_c(col), pattern, group), F.lit(""))


def safe_ratio(num: Column, den: Column, scale: int = 4) -> Column:
    """``round(num / nullif(den, 0), scale)``: NULL when the denominator is zero."""
    return F.round(num / F.nullif(den, F.lit(0)), scale)


def split_nonempty(col: str | Column, sep: str) -> Column:
    """Delimited string -> array without empty pieces (``',a,b,'`` -> ['a','b'])."""
    return F.filter(F.split(_c(col), sep), lambda x: x != F.lit(""))


def day_series(start: Column, stop: Column) -> Column:
    """Days from start to stop inclusive; empty (not descending) when start > stop or
    either end is NULL, like ``generate_series``."""
    return F.when(
        start.isNotNull() & stop.isNotNull() & (start <= stop),
        F.sequence(start, stop, F.expr("INTERVAL 1 DAY")),
    ).otherwise(F.array().cast("array<date>"))


# Strptime directive -> Spark datetime pattern letters.
_STRPTIME_TO_SPARK = {
    "%Y": "yyyy",
    "%m": "MM",
    "%d": "dd",
    "%H": "HH",
    "%M": "mm",
    "%S": "ss",
    "%f": "SSSSSS",
    "%z": "Z",
    "%y": "yy",
    "%b": "MMM",
    "%B": "MMMM",
    "%a": "EEE",
    "%A": "EEEE",
    "%p": "a",
    "%I": "hh",
    "%j": "DDD",
    "%%": "%",
}


def strptime_to_spark(fmt: str) -> str:
    """Translate a ``strptime`` pattern into a Spark datetime pattern.

    Literal text is quoted; unknown directives raise so a format is never silently
    misread.
    """
    out: list[str] = []
    literal: list[str] = []

    def flush() -> None:
        if literal:
            text = "".join(literal).replace("'", "''")
            out.append(text if all(ch in " -/:.," for ch in text) else f"'{text}'")
            literal.clear()

    i = 0
    while i < len(fmt):
        if fmt[i] == "%" and i + 1 < len(fmt):
            directive = fmt[i : i + 2]
            if directive not in _STRPTIME_TO_SPARK:
                raise ValueError(f"unsupported strptime directive {directive!r} in {fmt!r}")
            flush()
            out.append(_STRPTIME_TO_SPARK[directive])
            i += 2
        else:
            literal.append(fmt[i])
            i += 1
    flush()
    return "".join(out)


def parse_instant(col: str | Column, datetime_format: str | None = None) -> Column:
    """Parse an ISO-8601 string (offset-aware or naive-as-UTC), or the job format,
    or unix seconds when the format is ``epoch``. NULL when nothing matches."""
    c = _c(col)
    if datetime_format == "epoch":
        return F.timestamp_seconds(c.cast("long"))
    if not datetime_format:
        return F.try_to_timestamp(c)
    pattern = F.lit(strptime_to_spark(datetime_format))
    return once(c, lambda text: F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(text, pattern)))


def format_instant(col: str | Column, datetime_format: str) -> Column:
    """Render an instant with the job format (UTC), or as unix seconds for ``epoch``."""
    c = _c(col)
    if datetime_format == "epoch":
        return F.unix_seconds(c).cast("string")
    return F.date_format(c, strptime_to_spark(datetime_format))


def instant(value) -> Column:
    """A Python datetime as a Spark timestamp literal, independent of the Python
    process's and the session's time zone (naive values are read as UTC)."""
    from datetime import UTC

    aware = value if value.tzinfo else value.replace(tzinfo=UTC)
    micros = int(aware.timestamp()) * 1_000_000 + aware.microsecond
    return F.timestamp_micros(F.lit(micros))
