"""Publishing marts for a serving store as NDJSON batches.

A publish writes one JSON object per row (``to_json`` of the whole row, so
NULL fields are omitted, as on the original wire) into files sized by the bytes
of their input partitions, or of at most ``batch_rows`` rows where the serving
store wants batches of a row count. The partitioned variant writes one folder per key value
so that no batch ever spans two partition keys; rows inside a folder follow
the serving sort key. ``truncate`` replaces the previous publish, otherwise
rows are appended. The row count is observed during the write itself and
checked against a read-back of what was written; an append counts what was there
before as well. A total does not see rows in the wrong folder: with ``manifest``,
a partitioned publish also counts the rows of each key in its input, keeps the counts
beside the files and compares them key by key.

With ``ranges``, a partitioned publish is dealt by ranges of (key, sort key) in place
of the key alone: a large key is still written by several tasks, and its files do
not overlap in sort order.

JSON text repeats every key in every row: ``compression`` (``gzip``, say) writes each
file of a partitioned publish compressed, in a fraction of the bytes.

Everything stays in the JVM: no per-row Python and nothing collected on the
driver but counts, and the first keys that a failed audit names.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import wire_timestamp
from strata.schemas import ServingContract
from strata.sinks.writers import materialize
from strata.sources.tables import read_if_exists

log = logging.getLogger("strata.publish")

class PublishAuditError(RuntimeError):
    pass


@dataclass(frozen=True)
class PublishResult:
    table: str
    path: str
    rows_written: int
    rows_read_back: int | None


def _payload(df: DataFrame) -> F.Column:
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]))


def for_contract(df: DataFrame, contract: ServingContract) -> DataFrame:
    """``df`` with exactly the contract's columns in the wire types; NULLs in
    columns that the store declares non-null become its defaults there.

    A column the contract needs and ``df`` lacks is an error. Unsigned columns
    refuse negative numbers: the write fails rather than wrap around.
    """
    missing = [f.name for f in contract.schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{contract.name}: columns missing for the serving contract: {missing}")
    out = []
    for f in contract.schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if f.name in contract.unsigned:
            c = F.when(c < 0, F.raise_error(F.lit(f"{contract.name}.{f.name}: negative"))).otherwise(c)
        if f.name in contract.non_null:
            default = contract.default(f)
            c = F.coalesce(c, F.lit(default).cast(f.dataType))
        out.append(c.alias(f.name))
    return df.select(*out)


def wire_format(df: DataFrame) -> DataFrame:
    """Timestamps as ``yyyy-MM-dd HH:mm:ss`` text, the serving store's input format."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(wire_timestamp(f.name).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def _published_rows(spark: SparkSession, path: str) -> int:
    found = read_if_exists(spark, path, T.StructType([T.StructField("value", T.StringType())]), "text")
    return 0 if found is None else found.count()


def _audit(spark: SparkSession, table: str, path: str, written: int, before: int | None) -> PublishResult:
    """``before``: rows published at ``path`` before this write; None skips the audit."""
    read_back = None
    if before is not None:
        read_back = _published_rows(spark, path) - before
        if read_back != written:
            raise PublishAuditError(f"{table}: wrote {written} rows but {read_back} were added at {path}")
    log.info("publish table=%s rows=%s read_back=%s", table, written, read_back)
    return PublishResult(table, path, written, read_back)


def publish_rows(
    df: DataFrame,
    path: str,
    *,
    table: str,
    batch_rows: int | None = None,
    truncate: bool = True,
    audit: bool = True,
) -> PublishResult:
    """Row-batched NDJSON publish (no partition alignment)."""
    if batch_rows is not None and batch_rows < 1:
        raise ValueError("batch_rows must be >= 1")
    before = None if not audit else 0 if truncate else _published_rows(df.sparkSession, path)
    obs = Observation(f"publish_{table}")
    (
        df.select(_payload(df).alias("value"))
        .observe(obs, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite" if truncate else "append")
        .option("maxRecordsPerFile", batch_rows or 0)
        .text(path)
    )
    return _audit(df.sparkSession, table, path, int(obs.get["rows"]), before)


def publish_partitioned(
    df: DataFrame,
    path: str,
    *,
    table: str,
    partition_col: str,
    sort_key: Sequence[str] = (),
    batch_rows: int | None = None,
    truncate: bool = True,
    audit: bool = True,
    ranges: bool | int = False,
    manifest: bool = False,
    compression: str | None = None,
) -> PublishResult:
    """Partition-aligned NDJSON publish: one folder per ``partition_col`` value
    (NULL keys get the default-partition folder, never merged into another key),
    rows sorted by ``sort_key`` within a file. Rows are rebalanced by the key to
    the advisory partition size, so files are sized in bytes and a heavy key is
    split over several writer tasks; ``batch_rows`` cuts them further.

    ``ranges`` (or their number) deals rows by ranges of (key, ``sort_key``): the
    files of a key then follow each other in sort order without overlap, at the
    cost of a sampling pass over the input. ``manifest`` counts the input by key (from a
    stored mart: its folders and row counts alone) and audits each key. ``compression``
    names the codec of the files (None: plain text)."""
    if batch_rows is not None and batch_rows < 1:
        raise ValueError("batch_rows must be >= 1")
    spark = df.sparkSession
    before = None if not audit else 0 if truncate else _published_rows(spark, path)
    expected = materialize(_counts(df, partition_col), "publish-manifest") if manifest else None
    if manifest and not truncate and read_manifest(spark, path) is None:  # what was published without one
        there = _published_counts(spark, path, partition_col).withColumnRenamed("rows_published", "rows_expected")
        expected = materialize(expected.unionByName(there), "publish-manifest")
    obs = Observation(f"publish_{table}")
    order = [partition_col] + [c for c in sort_key if c != partition_col]
    if ranges:
        dealt = df.repartitionByRange(ranges, *order) if ranges is not True else df.repartitionByRange(*order)
    else:
        dealt = df.hint("rebalance", partition_col)
    keyed = (
        dealt.sortWithinPartitions(*order)
        .select(F.col(partition_col).cast("string").alias(partition_col), _payload(df).alias("value"))
        .observe(obs, F.count(F.lit(1)).alias("rows"))
    )
    (
        keyed.write.mode("overwrite" if truncate else "append")
        .option("maxRecordsPerFile", batch_rows or 0)
        .option("compression", compression or "none")
        .partitionBy(partition_col)
        .text(path)
    )
    if manifest:
        expected.coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/{MANIFEST}")  # a row a key
        if audit:
            verify_published(spark, path, partition_col, table)
    return _audit(spark, table, path, int(obs.get["rows"]), before)


# ---------------------------------------------------------------- manifest
#: hidden from readers of the publish, which skip names that begin so
MANIFEST = "_manifest"
_COUNTS = T.StructType([T.StructField("partition_value", T.StringType()), T.StructField("rows_expected", T.LongType())])


def _key(partition_col: str) -> F.Column:
    """A partition value as its folder gives it back: empty text has the folder of NULL."""
    return F.nullif(F.col(partition_col).cast("string"), F.lit("")).alias("partition_value")


def _counts(df: DataFrame, partition_col: str) -> DataFrame:
    return df.groupBy(_key(partition_col)).agg(F.count(F.lit(1)).alias("rows_expected"))


def _published_counts(spark: SparkSession, path: str, partition_col: str) -> DataFrame:
    """(partition_value, rows) of the files at ``path``, by folder."""
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField(partition_col, T.StringType())])
    found = read_if_exists(spark, path, schema, "text")
    rows = spark.createDataFrame([], schema) if found is None else found
    return _counts(rows, partition_col).withColumnRenamed("rows_expected", "rows_published")


def read_manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """(partition_value, rows_expected) of every publish at ``path``, added up; None where there is none."""
    kept = read_if_exists(spark, f"{path.rstrip('/')}/{MANIFEST}", _COUNTS, "json")
    return None if kept is None else kept.groupBy("partition_value").agg(F.sum("rows_expected").alias("rows_expected"))


def audited_partitions(spark: SparkSession, path: str, partition_col: str) -> DataFrame:
    """(partition_value, rows_expected, rows_published) by the manifest and by the files at ``path``."""
    expected = read_manifest(spark, path)
    if expected is None:
        raise PublishAuditError(f"no manifest at {path}")
    found = _published_counts(spark, path, partition_col).withColumnRenamed("partition_value", "_value")
    both = expected.join(found, F.col("partition_value").eqNullSafe(F.col("_value")), "full")
    zero = F.lit(0).cast("long")
    # of a NULL key both sides are NULL, of a key that one side lacks just one of them
    return both.select(
        F.coalesce("partition_value", "_value").alias("partition_value"),
        F.coalesce("rows_expected", zero).alias("rows_expected"), F.coalesce("rows_published", zero).alias("rows_published"),
    )


def verify_published(spark: SparkSession, path: str, partition_col: str, table: str = "") -> None:
    """Raise unless every key has the rows that the manifest says."""
    wrong = audited_partitions(spark, path, partition_col).where("rows_expected <> rows_published")
    named = [tuple(r) for r in wrong.orderBy("partition_value").limit(20).collect()]
    if named:
        raise PublishAuditError(f"{table or path}: (key, rows expected, rows published) differ: {named}")


def read_published(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a publish back with the serving contract's schema (wire timestamps parse)."""
    return spark.read.schema(schema).json(path).select(*[f.name for f in schema.fields])
