"""Generators that normalise list and JSON-map columns into relational rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import (
    CATEGORY_SEPARATOR,
    clean_attribute_key,
    hour_of,
    minute_of,
    minutes_of_day,
    parse_string_map,
    range_part,
)


def explode_list(
    df: DataFrame,
    id_col: str,
    list_col: str,
    out_col: str,
    separator: str = CATEGORY_SEPARATOR,
) -> DataFrame:
    """One row per element of a delimited text list.

    Elements are trimmed and blanks dropped; repeats are kept (a repeated
    element weights later averages, as upstream does).
    """
    return (
        df.select(id_col, list_col)
        .where(F.col(list_col).isNotNull())
        .select(id_col, F.explode(F.split(F.col(list_col), separator)).alias(out_col))
        .select(id_col, F.trim(F.col(out_col)).alias(out_col))
        .where(F.length(out_col) > 0)
    )


def explode_json_map(
    df: DataFrame,
    id_col: str,
    json_col: str,
    key_col: str = "key",
    value_col: str = "value",
    clean_keys: bool = False,
    drop_null_values: bool = False,
) -> DataFrame:
    """One row per entry of a JSON object held as text (entity-attribute-value).

    Primitives and nested objects come back as text; unparsable text and ``{}``
    give no rows. ``clean_keys`` strips Python-repr quoting from keys.
    """
    entries = (
        df.select(id_col, parse_string_map(F.col(json_col)).alias("__m"))
        .where(F.col("__m").isNotNull())
        .select(id_col, F.explode("__m").alias("__k", "__v"))
    )
    key = clean_attribute_key(F.col("__k")) if clean_keys else F.col("__k")
    out = entries.select(id_col, key.alias(key_col), F.col("__v").alias(value_col))
    if drop_null_values:
        out = out.where(F.col(value_col).isNotNull())
    return out


def explode_time_ranges(
    df: DataFrame,
    id_col: str = "business_id",
    json_col: str = "hours",
    day_col: str = "day_of_week",
) -> DataFrame:
    """One row per day of an opening-hours object ``{"Monday": "8:0-22:30", ...}``.

    Entries with a NULL range are dropped; malformed pieces give NULL parts.
    Minutes of day are ``h * 60 + m`` and are not adjusted for ranges that
    pass midnight.
    """
    days = explode_json_map(df, id_col, json_col, day_col, "__range").where(F.col("__range").isNotNull())
    open_s = range_part("__range", 0)
    close_s = range_part("__range", 1)
    parts = days.select(
        id_col,
        day_col,
        hour_of(open_s).alias("open_hour"),
        minute_of(open_s).alias("open_minute"),
        hour_of(close_s).alias("close_hour"),
        minute_of(close_s).alias("close_minute"),
    )
    return parts.select(
        "*",
        minutes_of_day("open_hour", "open_minute").alias("open_minutes"),
        minutes_of_day("close_hour", "close_minute").alias("close_minutes"),
    )
