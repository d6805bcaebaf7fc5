"""Incremental review ingestion: new NDJSON files are merged into the
month-partitioned fact.

``readStream`` over the increment folder with ``trigger(availableNow=True)``
picks up every file not yet seen (the stream checkpoint remembers which),
and ``foreachBatch`` merges each micro-batch:

1. malformed lines and reviews without an id go, with their text, to the
   batch's quarantine folder (overwritten when the batch is replayed); the rest
   is conformed to fact rows, and of several versions of a review the one from
   the newest file wins (the greatest row within a file time);
2. the months to rewrite are those of the batch's rows and those in which the
   fact holds older versions of its reviews, as the location index beside the
   fact says (``streaming.locations``; it is built at the first merge, and only
   the buckets of the batch's ids are read), so a review that moved to another
   month leaves the old one;
3. current rows of those months whose ``review_id`` is not in the batch stay,
   the batch rows are added;
4. the merged months are written once to the shared checkpoint folder, which
   cuts the lineage; the batch's places go into the index, then the merged months
   replace just those of the fact, and a month that lost its last review is dropped.

A replayed batch produces the same months again, so the merge is idempotent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.plans.core import review_fact
from strata.plans.landing import review_landing
from strata.schemas import CORRUPT_COL, REVIEW_FACT, REVIEW_RAW_READ
from strata.session import scratch_owner
from strata.operators.conform import cast_to_schema
from strata.sinks.tables import insert_overwrite_partitions, overwrite_partitions
from strata.sinks.writers import materialize
from strata.sources.ndjson import corrupt_text
from strata.sources.tables import read_if_exists
from strata.streaming.locations import LocationIndex

PARTITION = "ym"
FILE_TIME = "_file_time"
KEY = "review_id"
#: months up to which the scan of the fact is cut by a list of them; more go through a join
MOST_LISTED = 10_000


def _partition_folder(spark: SparkSession, month: str | None) -> str:
    """``ym=...`` as Spark's writer names it."""
    catalog = spark._jvm.org.apache.spark.sql.catalyst.catalog
    return catalog.ExternalCatalogUtils.getPartitionPathString(PARTITION, month)


@dataclass(frozen=True)
class PathFact:
    """The fact as a month-partitioned Parquet dataset at ``path``."""

    path: str

    def index(self) -> LocationIndex:
        """The location index beside the fact."""
        return LocationIndex(f"{self.path.rstrip('/')}_locations")

    def read(self, spark: SparkSession) -> DataFrame | None:
        return read_if_exists(spark, self.path, REVIEW_FACT)

    def replace_months(self, df: DataFrame) -> None:
        overwrite_partitions(df, self.path, PARTITION, REVIEW_FACT)

    def reload_months(self, df: DataFrame) -> None:
        _reload(self, df)

    def drop_months(self, spark: SparkSession, months: list[str | None]) -> None:
        for m in months:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path.rstrip('/')}/{_partition_folder(spark, m)}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@dataclass(frozen=True)
class TableFact:
    """The fact as a month-partitioned catalog table, created with its database
    on first use; external at ``path`` where one is given."""

    name: str
    path: str | None = None

    def index(self) -> LocationIndex | None:
        """The location index beside an external fact; a managed one has no place for it."""
        return PathFact(self.path).index() if self.path else None

    def reload_months(self, df: DataFrame) -> None:
        _reload(self, df)

    def read(self, spark: SparkSession) -> DataFrame | None:
        return spark.table(self.name) if spark.catalog.tableExists(self.name) else None

    def replace_months(self, df: DataFrame) -> None:
        spark = df.sparkSession
        if not spark.catalog.tableExists(self.name):
            if "." in self.name:
                spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.name.rpartition('.')[0]}")
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in REVIEW_FACT.fields)
            place = f" LOCATION '{self.path}'" if self.path else ""
            spark.sql(f"CREATE TABLE {self.name} ({cols}) USING parquet PARTITIONED BY ({PARTITION}){place}")
        insert_overwrite_partitions(cast_to_schema(df, REVIEW_FACT), self.name)

    def drop_months(self, spark: SparkSession, months: list[str | None]) -> None:
        for m in months:
            value = "null" if m is None else "'" + m.replace("'", "\\'") + "'"
            spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({PARTITION} = {value})")
        if self.path:
            PathFact(self.path).drop_months(spark, months)


FactTarget = PathFact | TableFact


def _reload(target: FactTarget, df: DataFrame) -> None:
    """Replace the months present in ``df``; an index that exists learns the new places first."""
    index = target.index()
    if index is not None and index.versions(df.sparkSession):
        index.add(df)
    target.replace_months(df)


def _target(fact: str | FactTarget) -> FactTarget:
    return PathFact(fact) if isinstance(fact, str) else fact


def tagged_batch(batch: DataFrame) -> DataFrame:
    """Raw review rows as fact rows with the file time, beside ``reason`` and ``raw_line``, which say
    what is wrong with a row (NULL: nothing); one pass over the raw text gives both."""
    if FILE_TIME not in batch.columns:
        batch = batch.withColumn(FILE_TIME, F.lit(None).cast("timestamp"))
    if CORRUPT_COL not in batch.columns:
        batch = batch.withColumn(CORRUPT_COL, F.lit(None).cast("string"))
    broken = corrupt_text(batch)
    raw = [c for c in batch.columns if c not in (CORRUPT_COL, FILE_TIME)]
    reason = F.when(broken.isNotNull(), "malformed").when(F.col(KEY).isNull(), "no_id")
    line = F.when(reason.isNotNull(), F.coalesce(broken, F.to_json(F.struct(*raw))))
    own = [FILE_TIME, "reason", "raw_line"]
    return review_fact(review_landing(batch.withColumns({"reason": reason, "raw_line": line}), passthrough=own), passthrough=own)


def newest_versions(rows: DataFrame) -> DataFrame:
    """One row a review: from the newest file, of equals the greatest row."""
    cols = [f.name for f in REVIEW_FACT.fields]
    newest = rows.groupBy(KEY).agg(F.max(F.struct(FILE_TIME, *[c for c in cols if c != KEY])).alias("_row"))
    return newest.select(*[F.col(c) if c == KEY else F.col(f"_row.{c}").alias(c) for c in cols])


def merge_batch(batch: DataFrame, fact: str | FactTarget, quarantine: str, batch_id: int = 0) -> None:
    """Merge one batch of raw review rows into the fact (a path or a ``TableFact``)."""
    with scratch_owner(batch.sparkSession):
        _merge(batch, _target(fact), quarantine, batch_id)


def _merge(batch: DataFrame, target: FactTarget, quarantine: str, batch_id: int) -> None:
    spark = batch.sparkSession
    tagged = materialize(tagged_batch(batch), "increment-rows")
    bad = tagged.where("reason IS NOT NULL").select("reason", "raw_line")
    bad.write.mode("overwrite").json(f"{quarantine.rstrip('/')}/batch={batch_id}")
    incoming = materialize(newest_versions(tagged.where("reason IS NULL")), "increment-batch")
    months = incoming.select(PARTITION).distinct()
    current = target.read(spark)
    merged = incoming
    index = target.index()
    if current is not None:
        ids = incoming.select(KEY)
        if index is not None and not index.versions(spark):
            index.build(current)
        older = index.months_of(ids) if index is not None else current.select(KEY, PARTITION).join(ids, KEY, "left_semi").select(PARTITION)
        months = materialize(months.unionByName(older).distinct(), "increment-months")
        kept = months_slice(current, months).join(ids, KEY, "left_anti")
        merged = kept.select(*incoming.columns).unionByName(incoming)
        # the write below replaces files that ``merged`` reads; materialise it first
        merged = materialize(merged, "increment-merged")
        left = merged.select(F.col(PARTITION).alias("_left")).distinct()
        emptied = months.join(left, F.col(PARTITION).eqNullSafe(F.col("_left")), "left_anti")
    if months.isEmpty():
        return
    if index is not None and index.versions(spark):
        index.add(incoming)
    target.replace_months(merged)
    if current is not None:
        # month keys that lost their last review, a bounded number at a time
        for part in in_parts(emptied):
            target.drop_months(spark, part)
    if index is not None:
        index.compact_if_due(spark)


def months_slice(current: DataFrame, months: DataFrame) -> DataFrame:
    """Rows of the fact in ``months``: a list of them cuts the scan to their folders when it is
    planned; beyond ``MOST_LISTED`` months it is a join."""
    listed = [r[0] for r in months.limit(MOST_LISTED + 1).collect()]
    if len(listed) <= MOST_LISTED:
        wanted = F.col(PARTITION).isin([m for m in listed if m is not None])
        return current.where(wanted | F.col(PARTITION).isNull() if None in listed else wanted)
    known = current.join(months, PARTITION, "left_semi")
    if months.where(F.col(PARTITION).isNull()).isEmpty():
        return known
    return known.unionByName(current.where(F.col(PARTITION).isNull()).select(*known.columns))


def in_parts(months: DataFrame) -> Iterator[list[str | None]]:
    """The month keys in lists of at most ``MOST_LISTED``."""
    part: list[str | None] = []
    for r in months.toLocalIterator():
        part.append(r[0])
        if len(part) == MOST_LISTED:
            yield part
            part = []
    if part:
        yield part


def quarantine_path(stream_checkpoint: str) -> str:
    return stream_checkpoint.rstrip("/") + "-quarantine"


def start_incremental_merge(
    spark: SparkSession,
    increment_dir: str,
    fact: str | FactTarget,
    stream_checkpoint: str,
    max_files_per_trigger: int | None = None,
    processing_time: str | None = None,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Start the merge stream; returns the query. ``quarantine`` (beside the
    stream's checkpoint by default) gets what cannot be merged, by batch.

    By default the trigger is ``availableNow``: every file present is processed,
    then the query stops (a scheduled job). ``processing_time`` (e.g.
    ``"5 minutes"``) keeps it running and merges new files at that interval.
    """
    schema = T.StructType(list(REVIEW_RAW_READ.fields) + [T.StructField(CORRUPT_COL, T.StringType(), True)])
    reader = (
        spark.readStream.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COL)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(increment_dir).select("*", F.col("_metadata.file_modification_time").alias(FILE_TIME))
    target = _target(fact)
    bad = quarantine or quarantine_path(stream_checkpoint)
    writer = stream.writeStream.foreachBatch(lambda df, batch_id: merge_batch(df, target, bad, batch_id)).option(
        "checkpointLocation", stream_checkpoint
    )
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()


def incremental_merge(
    spark: SparkSession,
    increment_dir: str,
    fact: str | FactTarget,
    stream_checkpoint: str,
    max_files_per_trigger: int | None = None,
    quarantine: str | None = None,
) -> DataFrame:
    """Run the merge until every available file is processed; return the fact."""
    q = start_incremental_merge(
        spark, increment_dir, fact, stream_checkpoint, max_files_per_trigger, quarantine=quarantine
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return _target(fact).read(spark)
