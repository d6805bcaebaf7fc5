"""Value clean-up applied before publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import finite_or_null


def sanitize_nan_inf(df: DataFrame) -> DataFrame:
    """Replace NaN, +Inf and -Inf by NULL in every floating-point column."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(finite_or_null(F.col(f.name)).cast(f.dataType).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def _default_for(dtype: T.DataType):
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return 0
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return 0.0
    if isinstance(dtype, T.StringType):
        return ""
    if isinstance(dtype, T.BooleanType):
        return False
    return None


def fill_defaults(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Turn NULLs into type defaults (0, 0.0, '', false), which is what a
    non-nullable serving column shows for a missing field. Off by default in
    every publish; call it explicitly to reproduce that view."""
    wanted = set(columns) if columns is not None else None
    out = []
    for f in df.schema.fields:
        default = _default_for(f.dataType)
        if default is None or (wanted is not None and f.name not in wanted):
            out.append(F.col(f.name))
        else:
            out.append(F.coalesce(F.col(f.name), F.lit(default).cast(f.dataType)).alias(f.name))
    return df.select(*out)
