"""Table and file writers: overwrite, dynamic partition overwrite, layer DDL."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.conform import cast_to_schema
from strata.schemas import LAYERS, PARTITIONED_TABLES
from strata.sinks.writers import PARQUET_CODEC, parquet_codec


def _balanced(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Ask adaptive execution for evenly sized output tasks.

    With keys, rows of one key end in few files; a key that is much larger
    than the advisory partition size is split over several tasks instead of
    being written by one.
    """
    return df.hint("rebalance", *keys) if keys else df.hint("rebalance")


def overwrite_parquet(df: DataFrame, path: str, schema: T.StructType | None = None, rebalance: bool = False,
                      partition_by: Sequence[str] = (), balanced: bool = False) -> None:
    """Replace the dataset at ``path``; ``balanced``: the rows already lie by ``partition_by``."""
    if schema is not None:
        df = cast_to_schema(df, schema)
    if (rebalance or partition_by) and not balanced:
        df = _balanced(df, partition_by)
    w = df.write.mode("overwrite").option("compression", parquet_codec(df.sparkSession))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_table(df: DataFrame, name: str, schema: T.StructType | None = None, mode: str = "overwrite",
               path: str | None = None, partition_by: Sequence[str] = (), balanced: bool = False) -> None:
    """Parquet table, managed or (with ``path``) external; the frame is cast to
    ``schema`` first so an overwrite cannot silently change the declared column types.
    ``balanced``: the rows already lie by ``partition_by``."""
    if schema is not None:
        df = cast_to_schema(df, schema)
    if partition_by and not balanced:
        df = _balanced(df, partition_by)
    w = df.write.mode(mode).format("parquet").option("compression", parquet_codec(df.sparkSession))
    if path:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def overwrite_partitions(
    df: DataFrame,
    path: str,
    partition_col: str,
    schema: T.StructType | None = None,
) -> None:
    """Dynamic partition overwrite into a path dataset.

    Only partitions present in ``df`` are replaced; all others stay as they
    are. NULL keys go to the default partition folder. Rows are rebalanced by
    the partition key first, so each task writes few partitions and a heavy
    month is split rather than written by one task.
    """
    if schema is not None:
        df = cast_to_schema(df, schema)
    (
        _balanced(df, [partition_col])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", parquet_codec(df.sparkSession))
        .partitionBy(partition_col)
        .parquet(path)
    )


def insert_overwrite_partitions(df: DataFrame, table_name: str) -> None:
    """Dynamic partition overwrite into a catalog table.

    ``insertInto`` is positional, so the frame is first put into the table's
    column order (partition column last).
    """
    spark = df.sparkSession
    target = spark.table(table_name)
    part_cols = [c.name for c in spark.catalog.listColumns(table_name) if c.isPartition]
    if not part_cols:
        raise ValueError(f"{table_name} is not partitioned; use save_table to replace it")
    ordered = df.select(*[F.col(c) for c in target.columns])
    ordered = _balanced(ordered, part_cols)
    # insertInto reads the overwrite mode from its session, not from writer options; a
    # session of its own leaves static overwrites running meanwhile as they are
    view = f"strata_insert_{uuid.uuid4().hex}"
    ordered.createGlobalTempView(view)
    try:
        own = spark.newSession()
        for key, value in spark.conf.getAll.items():
            if own.conf.isModifiable(key):
                own.conf.set(key, value)
        own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        own.conf.set(PARQUET_CODEC, parquet_codec(spark))
        own.table(f"{spark.conf.get('spark.sql.globalTempDatabase', 'global_temp')}.{view}").write.mode("overwrite").insertInto(table_name)
    finally:
        spark.catalog.dropGlobalTempView(view)
    spark.catalog.refreshTable(table_name)  # this session may know the files replaced


def analyze_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> None:
    """Store the table's size and row count in the catalog, and the distinct values, NULLs and bounds
    of those of ``columns`` it has (a scan of these columns). With ``spark.sql.cbo.enabled``
    Spark estimates filters and joins by them; a write does not renew them, so this follows one."""
    have = [c for c in spark.table(name).columns if columns is None or c in columns]
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    if have:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(f'`{c}`' for c in have)}")


def create_layers(spark: SparkSession, prefix: str = "strata", location: str | None = None,
                  landing_root: str | None = None) -> dict[str, str]:
    """Create one database per layer and every declared table (IF NOT EXISTS).

    Landing tables are external: they lie where the ingest writes its valid rows,
    ``{landing_root}/{table}/_landing_status=valid`` (declared only where
    ``landing_root`` is given). Returns layer -> database name.
    """
    dbs = {}
    for layer, tables in LAYERS.items():
        db = f"{prefix}_{layer}"
        loc = f" LOCATION '{location.rstrip('/')}/{db}.db'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")
        for name, schema in tables.items():
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            part = PARTITIONED_TABLES.get(name)
            clause = f" PARTITIONED BY ({part})" if part else ""
            if layer == "landing":
                if not landing_root:
                    continue
                clause = f" LOCATION '{landing_root.rstrip('/')}/{name}/_landing_status=valid'"
            spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{name} ({cols}) USING parquet{clause}")
        dbs[layer] = db
    return dbs


def drop_layers(spark: SparkSession, prefix: str = "strata") -> None:
    """Drop marts before core before landing, then the databases."""
    for layer in reversed(list(LAYERS)):
        db = f"{prefix}_{layer}"
        for name in LAYERS[layer]:
            spark.sql(f"DROP TABLE IF EXISTS {db}.{name}")
        spark.sql(f"DROP DATABASE IF EXISTS {db}")
