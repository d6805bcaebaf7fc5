"""Plain file writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


PARQUET_CODEC = "spark.sql.parquet.compression.codec"


def parquet_codec(spark: SparkSession) -> str:
    """The session's Parquet codec where it sets one, else zstd: smaller files than
    Spark's own default for the same rows, at modest CPU cost."""
    return spark.conf.getAll.get(PARQUET_CODEC, "zstd")


def write_ndjson(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "gzip") -> None:
    """One JSON object per line (``to_json`` of the row: NULL fields omitted,
    maps and structs nested). The text repeats every key in every row, so it is
    written gzipped, each task's file on its own; ``compression`` may say otherwise."""
    rows = df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))
    rows.write.mode(mode).option("compression", compression).text(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    return a frame reading it back.

    This cuts the lineage like ``checkpoint()`` (a lost executor re-reads the
    files instead of recomputing the plan) but computes the plan only once and
    keeps the data columnar, so later reads are pruned.
    """
    from strata.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", parquet_codec(df.sparkSession)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
