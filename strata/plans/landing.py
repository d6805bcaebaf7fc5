"""Landing: raw NDJSON feeds to typed rows.

``business_landing`` / ``review_landing`` are pure transforms (raw frame in,
landing frame out). ``land_ndjson`` is the job step: one pass over the input
that writes valid and malformed lines side by side, partitioned by a
quarantine flag, so nothing is parsed twice and no line is silently lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import compact_json_object
from strata.operators.conform import conform
from strata.schemas import (
    BUSINESS_LANDING,
    BUSINESS_RAW_READ,
    CORRUPT_COL,
    REVIEW_LANDING,
    REVIEW_RAW_READ,
)
from strata.sinks.writers import materialize, parquet_codec
from strata.sources.ndjson import corrupt_text, read_ndjson, valid_rows

STATUS_COL = "_landing_status"
VALID, QUARANTINE = "valid", "quarantine"


def _json_object_text(df: DataFrame, name: str):
    """Converter for a JSON-object column: NULL-valued keys are dropped and the
    object is kept as compact text. Works on text or on an already parsed map."""
    if name in df.columns and isinstance(df.schema[name].dataType, T.MapType):
        return lambda c: F.to_json(F.map_filter(c, lambda k, v: v.isNotNull()))
    return compact_json_object


def business_landing(raw: DataFrame, passthrough: Sequence[str] = ()) -> DataFrame:
    """Conform raw businesses to the landing contract."""
    return conform(
        raw,
        BUSINESS_LANDING,
        converters={
            "attributes": _json_object_text(raw, "attributes"),
            "hours": _json_object_text(raw, "hours"),
        },
        passthrough=passthrough,
    )


def review_landing(raw: DataFrame, passthrough: Sequence[str] = ()) -> DataFrame:
    """Conform raw reviews: ``date`` text becomes ``review_date`` (NULL when unparsable)."""
    return conform(raw, REVIEW_LANDING, source_names={"review_date": "date"}, passthrough=passthrough)


LANDING = {
    "business": (BUSINESS_RAW_READ, business_landing, BUSINESS_LANDING),
    "review": (REVIEW_RAW_READ, review_landing, REVIEW_LANDING),
}


def read_raw(spark: SparkSession, kind: str, src: str | list[str]) -> DataFrame:
    """Raw NDJSON scan for ``kind`` ('business' or 'review'), corrupt-record column included."""
    read_schema, _, _ = LANDING[kind]
    return read_ndjson(spark, src, read_schema)


def landing_from_ndjson(spark: SparkSession, kind: str, src: str | list[str]) -> DataFrame:
    """Valid rows of an NDJSON feed, conformed (lazy; nothing is written)."""
    _, transform, _ = LANDING[kind]
    return transform(valid_rows(read_raw(spark, kind, src)))


def land_ndjson(spark: SparkSession, kind: str, src: str | list[str], dst: str, rebalance: bool = False) -> None:
    """Write the landing dataset for ``kind`` at ``dst``.

    Valid rows go to ``dst/_landing_status=valid``, malformed lines (original
    text in ``_corrupt_record``, data columns NULL) to
    ``dst/_landing_status=quarantine``.
    Splittable NDJSON lands in files sized by the input splits (small input
    files are packed into shared splits), so no shuffle is needed. Set
    ``rebalance`` for non-splittable input such as large gzip files: adaptive
    execution then evens the output out to the advisory size, at the cost of
    one shuffle of the data.
    """
    if not dst or not dst.strip():
        raise ValueError("destination path must be non-empty")
    _, transform, _ = LANDING[kind]
    raw = read_raw(spark, kind, src)
    status = F.when(corrupt_text(raw).isNull(), F.lit(VALID)).otherwise(F.lit(QUARANTINE))
    raw = raw.withColumn(STATUS_COL, status)
    out = transform(raw, passthrough=(CORRUPT_COL, STATUS_COL))
    if rebalance:
        out = out.hint("rebalance")
    out.write.mode("overwrite").option("compression", parquet_codec(spark)).partitionBy(STATUS_COL).parquet(dst)


def _stored_schema(kind: str) -> T.StructType:
    """What a landing dataset holds; reading with it works for an empty feed too."""
    _, _, schema = LANDING[kind]
    extra = [T.StructField(CORRUPT_COL, T.StringType()), T.StructField(STATUS_COL, T.StringType())]
    return T.StructType(list(schema.fields) + extra)


def read_landing(spark: SparkSession, kind: str, dst: str) -> DataFrame:
    """Valid landing rows (the quarantine folder is pruned away at listing time)."""
    _, _, schema = LANDING[kind]
    df = spark.read.schema(_stored_schema(kind)).parquet(dst)
    return df.where(F.col(STATUS_COL) == VALID).select(*[f.name for f in schema.fields])


def read_quarantine(spark: SparkSession, dst: str, kind: str = "business") -> DataFrame:
    """Malformed input lines captured by ``land_ndjson`` (``kind`` tells the dataset's columns)."""
    return spark.read.schema(_stored_schema(kind)).parquet(dst).where(F.col(STATUS_COL) == QUARANTINE).select(
        F.col(CORRUPT_COL).alias("raw_line")
    )


# ---------------------------------------------------------------- sizes of the landed files
def landed_files(spark: SparkSession, dst: str) -> DataFrame:
    """(status, file, bytes) of every file of a landing dataset; nothing in them is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(dst)
    status = F.regexp_extract("path", f"{STATUS_COL}=([^/]+)/", 1)
    return files.select(status.alias("status"), F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"))


def landing_report(spark: SparkSession, dst: str, target_bytes: int) -> DataFrame:
    """Per status: files, bytes, files of under a quarter of ``target_bytes``, files of over twice
    as many, and the files that the bytes would fill."""
    small, large = F.col("bytes") < target_bytes // 4, F.col("bytes") > 2 * target_bytes
    return landed_files(spark, dst).groupBy("status").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum(small.cast("long")).alias("small"),
        F.sum(large.cast("long")).alias("large"), F.ceil(F.sum("bytes") / F.lit(target_bytes)).alias("wanted"),
    )


def compact_landing(spark: SparkSession, kind: str, dst: str, target_bytes: int = 128 << 20) -> list[str]:
    """Rewrite each status of the landing dataset that has more than one small file, in files of about
    ``target_bytes``; returns the statuses rewritten. The rows are first written to the shared scratch
    folder and then replace their partition, so a break loses none."""
    due = landing_report(spark, dst, target_bytes).where("small > 1 AND files > wanted").collect()  # two statuses at most
    stored = spark.read.schema(_stored_schema(kind)).parquet(dst)
    for r in due:
        rows = materialize(stored.where(F.col(STATUS_COL) == r["status"]), "landing-compact")
        out = rows.repartition(max(1, r["wanted"]))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(STATUS_COL).parquet(dst)
    return sorted(r["status"] for r in due)
