"""Catalog / path table scans, including the month-pruned fact scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from strata.schemas import FACT_PARTITION_COL


def path_missing(error: AnalysisException) -> bool:
    """Whether ``error`` says that a path does not exist (and nothing else)."""
    return error.getCondition() == "PATH_NOT_FOUND"


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame | None:
    """The dataset at ``path``, or None where there is none; any other failure is raised."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as e:
        if path_missing(e):
            return None
        raise


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table by name, or a dataset by path (anything with a '/')."""
    if "/" in name_or_path or ":" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def read_month_slice(
    spark: SparkSession,
    fact: str | DataFrame,
    ym_from: str | None = None,
    ym_to: str | None = None,
    schema: T.StructType | None = None,
    partition_col: str = FACT_PARTITION_COL,
) -> DataFrame:
    """Fact rows with ``ym_from <= ym <= ym_to`` (either bound optional).

    The bounds are on the partition column, so the scan lists and reads only
    the matching ``ym=...`` folders (``PartitionFilters`` in the plan).
    """
    if isinstance(fact, DataFrame):
        df = fact
    elif schema is not None:
        df = spark.read.schema(schema).parquet(fact)
    else:
        df = read_table(spark, fact)
    cond = F.lit(True)
    if ym_from is not None:
        cond = cond & (F.col(partition_col) >= F.lit(ym_from))
    if ym_to is not None:
        cond = cond & (F.col(partition_col) <= F.lit(ym_to))
    return df.where(cond)


def register_external(spark: SparkSession, name: str, path: str, schema: T.StructType, fmt: str = "parquet",
                      partition_cols: tuple[str, ...] = ()) -> None:
    """``CREATE TABLE IF NOT EXISTS name (...) USING fmt LOCATION path`` (an unmanaged table)."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {fmt}{part} LOCATION '{path}'")
    if partition_cols:
        spark.sql(f"MSCK REPAIR TABLE {name}")
