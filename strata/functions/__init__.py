"""Column-level building blocks (built-in Spark expressions only)."""

from strata.functions.columns import (
    clean_attribute_key,
    compact_json_object,
    finite_or_null,
    hour_of,
    minute_of,
    minutes_of_day,
    parse_string_map,
    range_part,
    to_double,
    to_int,
    to_timestamp_ntz,
    wire_timestamp,
    year_month,
)

__all__ = [
    "clean_attribute_key",
    "compact_json_object",
    "finite_or_null",
    "hour_of",
    "minute_of",
    "minutes_of_day",
    "parse_string_map",
    "range_part",
    "to_double",
    "to_int",
    "to_timestamp_ntz",
    "wire_timestamp",
    "year_month",
]
