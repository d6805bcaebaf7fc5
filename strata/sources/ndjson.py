"""NDJSON scan with an explicit schema and a quarantine for malformed lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.schemas import CORRUPT_COL


def read_ndjson(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    corrupt_col: str = CORRUPT_COL,
) -> DataFrame:
    """Read newline-delimited JSON with ``schema`` (no inference pass).

    The read is PERMISSIVE: a malformed line becomes a row whose
    ``corrupt_col`` holds the original text. Keys absent from a line come back
    as NULL. With an all-STRING schema, numbers arrive as their literal text and
    nested objects as compact JSON text, so typing is decided later by
    ``operators.conform``.
    """
    if not path or (isinstance(path, str) and not path.strip()):
        raise ValueError("source path must be non-empty")
    full = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType(), True)])
    return (
        spark.read.schema(full)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt_col)
        .json(path)
    )


def corrupt_text(df: DataFrame, corrupt_col: str = CORRUPT_COL) -> Column:
    """The corrupt-record text, read *through* a data column.

    Spark refuses a raw JSON scan whose only required column is the corrupt
    record (e.g. ``count()`` after a validity filter prunes everything else);
    tying the value to a data column keeps that column in the scan.
    """
    anchor = F.col([c for c in df.columns if c != corrupt_col][0])
    return F.when(anchor.isNull() | anchor.isNotNull(), F.col(corrupt_col))


def valid_rows(df: DataFrame, corrupt_col: str = CORRUPT_COL) -> DataFrame:
    """Rows that parsed; the corrupt-record column is dropped."""
    return df.where(corrupt_text(df, corrupt_col).isNull()).drop(corrupt_col)


def quarantined_rows(df: DataFrame, corrupt_col: str = CORRUPT_COL) -> DataFrame:
    """Original text of the lines that did not parse."""
    text = corrupt_text(df, corrupt_col)
    return df.where(text.isNotNull()).select(text.alias("raw_line"))

