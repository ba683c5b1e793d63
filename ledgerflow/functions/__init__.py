from ledgerflow.functions.scalars import (
    flag,
    week_start,
    is_weekday,
    regex_substring,
    safe_ratio,
    split_nonempty,
    strptime_to_spark,
    parse_instant,
    format_instant,
    day_series,
)

__all__ = [
    "flag",
    "week_start",
    "is_weekday",
    "regex_substring",
    "safe_ratio",
    "split_nonempty",
    "strptime_to_spark",
    "parse_instant",
    "format_instant",
    "day_series",
]
