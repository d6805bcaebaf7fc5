"""Where each review lies: a stored table review_id -> month beside the fact.

A merge must find the months that hold older versions of its reviews. Instead of
the fact's months it reads this table, cut by a hash of the id into ``bucket``
folders, and of these only the buckets of its own ids.

The table is a log: each merge adds the new places of its ids in a folder of its
own (``version=N/bucket=B``), before the fact's months change, so the table may
name a month too many, never one too few, wherever a merge breaks off; a month too
many is read and written again unchanged. ``compact`` keeps the latest version of
each id; it writes a hidden folder, renames it and then drops the older ones, and
whatever step is missing, the rest still holds all places.

All writers of the fact go through a target that keeps the table
(``streaming.incremental``); after other changes ``build`` makes it anew, and
``missing`` lists what it lacks.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sinks.writers import parquet_codec
from strata.sources.tables import read_if_exists

KEY, PARTITION = "review_id", "ym"
BUCKET, VERSION = "bucket", "version"
STORED = T.StructType([
    T.StructField(KEY, T.StringType()), T.StructField(PARTITION, T.StringType()),
    T.StructField(VERSION, T.LongType()), T.StructField(BUCKET, T.IntegerType()),
])


@dataclass(frozen=True)
class LocationIndex:
    """The table at ``path``. ``buckets`` is fixed when it is built; after ``compact_after``
    merges the log is compacted."""

    path: str
    buckets: int = 64
    compact_after: int = 16

    # ---- folders
    def _folder(self, spark: SparkSession, name: str = ""):
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path.rstrip('/')}/{name}" if name else self.path)
        return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder

    def versions(self, spark: SparkSession) -> list[int]:
        fs, folder = self._folder(spark)
        if not fs.exists(folder):
            return []
        names = [x.getPath().getName() for x in fs.listStatus(folder)]
        return sorted(int(x.partition("=")[2]) for x in names if x.startswith(f"{VERSION}="))

    def _dealt(self, places: DataFrame) -> DataFrame:
        """Distinct places, each bucket in one task: equal places share a bucket, so dealing by it is
        the only shuffle. In order of the ids, which then compress well."""
        dealt = places.select(KEY, PARTITION, self.bucket().alias(BUCKET)).where(F.col(KEY).isNotNull())
        return dealt.repartition(BUCKET).distinct().sortWithinPartitions(BUCKET, KEY)

    def _write(self, places: DataFrame, folder: str) -> None:
        w = self._dealt(places).write.mode("overwrite").option("compression", parquet_codec(places.sparkSession))
        w.partitionBy(BUCKET).parquet(f"{self.path.rstrip('/')}/{folder}")

    def bucket(self):
        return F.pmod(F.xxhash64(KEY), F.lit(self.buckets)).cast("int")

    # ---- reading
    def read(self, spark: SparkSession) -> DataFrame | None:
        """Every entry of the log."""
        return read_if_exists(spark, self.path, STORED) if self.versions(spark) else None

    def locations(self, spark: SparkSession) -> DataFrame:
        """(review_id, ym): the latest places."""
        log = self.read(spark)
        if log is None:
            return spark.createDataFrame([], STORED).select(KEY, PARTITION)
        latest = log.groupBy(KEY).agg(F.max(VERSION).alias("_v"), F.collect_set(F.struct(VERSION, F.col(PARTITION))).alias("_p"))
        # a review's few places; a fact loaded with repeats may hold it in several months at once
        return latest.select(KEY, F.explode(F.filter("_p", lambda p: p[VERSION] == F.col("_v"))).alias("p")).select(KEY, f"p.{PARTITION}")

    def months_of(self, ids: DataFrame) -> DataFrame | None:
        """(ym): every month in which one of ``ids`` may lie, from the buckets of these ids alone.
        Ids meet by a 64-bit hash, a third as long: where two share one, the list may
        name a month too many, as the table itself may."""
        log = self.read(ids.sparkSession)
        if log is None:
            return None
        ids = ids.where(F.col(KEY).isNotNull())
        numbers = sorted(r[0] for r in ids.select(self.bucket().alias(BUCKET)).distinct().collect())  # at most ``buckets``
        own = log.where(F.col(BUCKET).isin(numbers)).select(F.xxhash64(KEY).alias("_hash"), PARTITION)
        return own.join(ids.select(F.xxhash64(KEY).alias("_hash")), "_hash", "left_semi").select(PARTITION).distinct()

    def missing(self, fact: DataFrame) -> DataFrame:
        """(review_id, ym) of the fact that the table does not name."""
        log = self.read(fact.sparkSession)
        held = fact.where(F.col(KEY).isNotNull()).select(KEY, PARTITION).distinct()
        if log is None:
            return held
        same = [F.col(f"f.{KEY}") == F.col(f"i.{KEY}"), F.col(f"f.{PARTITION}").eqNullSafe(F.col(f"i.{PARTITION}"))]
        return held.alias("f").join(log.alias("i"), same, "left_anti")

    # ---- writing
    def add(self, places: DataFrame) -> None:
        """Append the places (review_id, ym) as the newest version."""
        self._write(places, f"{VERSION}={max(self.versions(places.sparkSession), default=0) + 1}")

    def build(self, fact: DataFrame) -> None:
        """Make the table from the whole fact, in place of what was there."""
        self._replace(fact.sparkSession, fact.select(KEY, PARTITION))

    def compact(self, spark: SparkSession) -> None:
        if len(self.versions(spark)) > 1:
            self._replace(spark, self.locations(spark))

    def compact_if_due(self, spark: SparkSession) -> None:
        if len(self.versions(spark)) > self.compact_after:
            self.compact(spark)

    def _replace(self, spark: SparkSession, places: DataFrame) -> None:
        older = self.versions(spark)
        hidden, new = f".compacting-{uuid.uuid4().hex}", f"{VERSION}={max(older, default=0) + 1}"
        self._write(places, hidden)
        fs, made = self._folder(spark, hidden)
        fs.rename(made, self._folder(spark, new)[1])
        for v in older:
            fs.delete(self._folder(spark, f"{VERSION}={v}")[1], True)
