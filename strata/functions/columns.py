"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values (must stay as written) ----------------------------------
# Category lists are split on a comma followed by optional whitespace.
CATEGORY_SEPARATOR = r",\s*"
# Attribute keys arrive as u'Key', 'Key', "Key", u"Key" or Key. The leading
# quote (optionally prefixed by u) and the trailing quote are removed; both
# alternatives are anchored so a quote inside a key is left alone.
ATTRIBUTE_KEY_QUOTES = r"^u?['\"]|['\"]$"
# An opening/closing time looks like H:M with one or two digits each.
HOUR_PATTERN = r"^(\d{1,2})"
MINUTE_PATTERN = r"^\d{1,2}:(\d{1,2})"
TIME_RANGE_SEPARATOR = "-"
# A whole number, a decimal number without a type suffix, and a number with one.
WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"
PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
SUFFIXED_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[dDfF]\s*$"
MONTH_KEY_FORMAT = "yyyy-MM"
WIRE_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
# ---------------------------------------------------------------------------

STRING_MAP = T.MapType(T.StringType(), T.StringType(), True)
JSON_MAP_OPTIONS = {"primitivesAsString": "true"}


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: str | Column) -> Column:
    """String or number to DOUBLE; unparsable text becomes NULL, and so does a
    number with a type suffix (``"5d"``), which the cast alone would accept."""
    return F.when(~col_(c).cast("string").rlike(SUFFIXED_NUMBER), col_(c).try_cast("double"))


def to_integral(c: str | Column, dtype: str) -> Column:
    """String or number to an integer type: exact where the text is an integer,
    by way of DOUBLE for plain decimals (``"5.0"``), else NULL (junk, overflow).

    The text's form decides which cast it gets: a cast that fails costs an
    exception a row, so none is tried that can fail for its form."""
    text = col_(c).cast("string")
    whole = F.when(text.rlike(WHOLE_NUMBER), col_(c).try_cast(dtype))
    return whole.when(text.rlike(PLAIN_NUMBER), col_(c).try_cast("double").try_cast(dtype))


def to_int(c: str | Column) -> Column:
    """String or number to INT. ``"5.0"`` reads as 5; junk and overflow become NULL."""
    return to_integral(c, "int")


def to_timestamp_ntz(c: str | Column) -> Column:
    """Text such as ``yyyy-MM-dd HH:mm:ss`` (or a date) to a timestamp in the
    session's zone (UTC in every profile), else NULL. A UTC offset in the text is
    applied, so ``2020-01-31T23:30:00-05:00`` is in February."""
    return col_(c).try_cast("timestamp").cast("timestamp_ntz")


def year_month(c: str | Column) -> Column:
    """Timestamp to its ``yyyy-MM`` month key (NULL stays NULL)."""
    return F.date_format(col_(c), MONTH_KEY_FORMAT)


def wire_timestamp(c: str | Column) -> Column:
    """Timestamp rendered as ``yyyy-MM-dd HH:mm:ss`` text for the serving wire."""
    return F.date_format(col_(c), WIRE_TIMESTAMP_FORMAT)


def clean_attribute_key(c: str | Column) -> Column:
    """Strip the Python-repr quoting some attribute keys carry."""
    return F.regexp_replace(col_(c), ATTRIBUTE_KEY_QUOTES, "")


def parse_string_map(c: str | Column) -> Column:
    """JSON object text to ``map<string,string>``; primitives and nested objects become text.

    Unparsable text and non-objects give NULL, ``{}`` gives an empty map.
    """
    return F.from_json(col_(c), STRING_MAP, JSON_MAP_OPTIONS)


def compact_json_object(c: str | Column) -> Column:
    """Normalise a JSON object held as text: drop keys whose value is null.

    Text that is not a JSON object is kept unchanged, so the split step can
    still see (and skip) it.
    """
    text = col_(c)
    # one parse per row: to_json of an unparsable (NULL) map is NULL, so the raw text is kept
    return F.coalesce(F.to_json(F.map_filter(parse_string_map(text), lambda k, v: v.isNotNull())), text)


def hour_of(c: str | Column) -> Column:
    return F.regexp_extract(col_(c), HOUR_PATTERN, 1).try_cast("int")


def minute_of(c: str | Column) -> Column:
    return F.regexp_extract(col_(c), MINUTE_PATTERN, 1).try_cast("int")


def minutes_of_day(hour: str | Column, minute: str | Column) -> Column:
    """``h * 60 + m``; overnight ranges are not adjusted."""
    return col_(hour) * 60 + col_(minute)


def range_part(c: str | Column, index: int) -> Column:
    """``index``-th (0-based) piece of an ``open-close`` range, NULL when missing."""
    return F.get(F.split(col_(c), TIME_RANGE_SEPARATOR), index)


def finite_or_null(c: str | Column) -> Column:
    """NaN, +Inf and -Inf become NULL; other values pass through."""
    x = col_(c)
    return F.when(F.isnan(x) | x.isin(float("inf"), float("-inf")), F.lit(None).cast("double")).otherwise(x)
