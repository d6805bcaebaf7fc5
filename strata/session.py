"""Session construction and shared-storage helpers.

Two execution profiles mirror the ones the original jobs were submitted with:
``mvp`` (adaptive execution on, partition coalescing on, 32 shuffle partitions
unless overridden) and ``debug`` (adaptive execution off, 8 partitions). A
third, ``cluster``, is sized for very large inputs (wide initial shuffles that
adaptive execution coalesces to 256 MB, skew splitting on).
Every profile pins the session time zone to UTC and keeps ANSI mode on; the
library uses ``try_cast`` / ``try_to_timestamp`` where bad input must become
NULL instead of failing the job.
"""

from __future__ import annotations

import logging
import math
import os
import tempfile
import threading
import uuid
from collections.abc import Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

log = logging.getLogger("strata")

# fixed values: the settings of mvp and debug
PROFILES: dict[str, dict[str, str]] = {
    "mvp": {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": os.environ.get("SPARK_SQL_SHUFFLE_PARTITIONS", "32"),
    },
    "debug": {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    },
    # large inputs: start wide and let adaptive execution coalesce shuffle
    # output to the advisory size; split skewed join/rebalance partitions
    "cluster": {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.files.maxPartitionBytes": "256m",
        # adaptive execution merges small partitions but splits only skewed ones, so the
        # initial number is high: 100 TB in 256 MB partitions needs about 400,000, and
        # shuffle_partitions_for() derives it from the input where its size is known
        "spark.sql.shuffle.partitions": os.environ.get("SPARK_SQL_SHUFFLE_PARTITIONS", "40000"),
        # a dimension read from its written table is broadcast only when Spark's
        # size estimate is under this bound; larger ones use a shuffle join
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        # tables with stored statistics (sinks.tables.analyze_table) are estimated by them
        "spark.sql.cbo.enabled": "true",
        # smaller files and scans than snappy for the same data, at modest CPU cost
        "spark.sql.parquet.compression.codec": "zstd",
    },
}

COMMON_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # dynamic partition overwrite is opted into per write; keep the session default static
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(
    app: str = "strata",
    profile: str = "mvp",
    extra_conf: Mapping[str, str] | None = None,
    master: str | None = None,
) -> SparkSession:
    """Create (or reuse) a SparkSession configured with ``profile``.

    ``extra_conf`` wins over the profile. ``master`` is only needed outside
    ``spark-submit`` (tests, local runs).
    """
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}; expected one of {sorted(PROFILES)}")
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**COMMON_CONF, **PROFILES[profile], **dict(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared filesystem folder and is
    used as is. A private temporary folder is created only on a ``local`` master
    without the setting (tests); on a cluster, where each machine would see its
    own, a missing setting is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote (Connect) sessions have no SparkContext
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder for this session") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a folder shared by the driver and all executors on " + sc.master
            )
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
        log.info("spark.checkpoint.dir unset; using %s", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shuffle_partitions_for(input_bytes: int, partition_bytes: int = 256 << 20, expansion: float = 2.0) -> int:
    """Initial shuffle partitions for a job over ``input_bytes`` of compressed
    columnar input: shuffled rows take about ``expansion`` times that."""
    return max(32, math.ceil(input_bytes * expansion / partition_bytes))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint directory.

    Used for written intermediate tables and read-back checks, so that every
    executor (and a restarted one) sees the same files.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/strata/{name}-{uuid.uuid4().hex[:12]}"
    owned = getattr(_OWNERS, "paths", None)
    if owned is not None:
        owned.append(path)
    return path


_OWNERS = threading.local()


@contextmanager
def scratch_owner(spark: SparkSession):
    """Own the scratch folders made inside: they are deleted when the block ends,
    so nothing lazy that reads them may leave it. Blocks of one thread nest."""
    outer = getattr(_OWNERS, "paths", None)
    _OWNERS.paths = []
    try:
        yield
    finally:
        made, _OWNERS.paths = _OWNERS.paths, outer
        for path in made:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def log_kv(**kwargs: object) -> None:
    """Structured ``key=value`` progress line."""
    log.info(" ".join(f"{k}={v}" for k, v in kwargs.items()))
