"""Schema conformance: one projection that adds missing columns, converts types
and fixes the column order to a declared ``StructType``."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import to_double, to_int, to_integral, to_timestamp_ntz


def _default_converter(dtype: T.DataType) -> Callable[[Column], Column]:
    if isinstance(dtype, T.IntegerType):
        return to_int
    if isinstance(dtype, T.LongType):
        return lambda c: to_integral(c, "bigint")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return lambda c: to_double(c).cast(dtype)
    if isinstance(dtype, T.TimestampNTZType):
        return to_timestamp_ntz
    return lambda c: c.try_cast(dtype)


def conform(
    df: DataFrame,
    schema: T.StructType,
    converters: Mapping[str, Callable[[Column], Column]] | None = None,
    source_names: Mapping[str, str] | None = None,
    passthrough: Sequence[str] = (),
) -> DataFrame:
    """Return ``df`` shaped exactly as ``schema`` (plus ``passthrough`` columns, unchanged, at the end).

    * a field missing from ``df`` becomes a typed NULL column;
    * a present field is converted with ``converters[name]`` if given, else by
      target type (``try_cast`` based: bad values become NULL, never an error);
    * ``source_names`` maps a target field to a differently named input column;
    * extra input columns are dropped and the output order is ``schema``'s.

    Everything happens in a single ``select``, so Catalyst sees one projection
    and prunes unused input columns at the scan.
    """
    converters = dict(converters or {})
    source_names = dict(source_names or {})
    present = set(df.columns)
    out = []
    for f in schema.fields:
        src = source_names.get(f.name, f.name)
        if src not in present:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(src)
        if f.name in converters:
            expr = converters[f.name](c)
        elif df.schema[src].dataType == f.dataType:
            expr = c
        else:
            expr = _default_converter(f.dataType)(c)
        out.append(expr.cast(f.dataType).alias(f.name))
    out.extend(F.col(c) for c in passthrough)
    return df.select(*out)


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Strict variant for writes: every field must exist; values are cast to the declared type."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for declared schema: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
