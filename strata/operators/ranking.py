"""Ranking within groups.

``rank_within_groups`` numbers *every* row of every group without sending a
group to one task: a hot group (say a category holding a third of all rows)
is range-partitioned across many tasks like any other key range, each task
numbers its slice, and a small per-(partition, group) offset table turns the
local numbers into global ones.

``top_k_per_group`` keeps only the first ``k`` rows per group; Spark plans it
with a partial ``WindowGroupLimit`` before the shuffle, so at most ``k`` rows
per group leave each input task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir
from strata.sinks.writers import materialize

_PID = "__pid"
_SEQ = "__seq"
_FIRST = "__first"
_CNT = "__cnt"
_OFF = "__off"
_OPID = "__opid"


def _sort_keys(group_cols: Sequence[str], order_cols: Sequence[Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in group_cols] + list(order_cols)


def rank_within_groups(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[Column],
    rank_col: str = "rn",
    num_partitions: int | None = None,
) -> DataFrame:
    """Exact ``row_number() OVER (PARTITION BY group ORDER BY order_cols)`` for all rows.

    ``order_cols`` should make the order total within a group (end with a
    unique column) so that the numbering is reproducible.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    group_cols = list(group_cols)
    keys = _sort_keys(group_cols, order_cols)

    # 1. global order: range partitioning splits a large group over many tasks.
    #    Without an explicit count, adaptive execution may merge neighbouring
    #    small ranges (still in order) but never a range above the advisory size.
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    tagged = (
        ranged.sortWithinPartitions(*keys)
        .select("*", F.spark_partition_id().alias(_PID), F.monotonically_increasing_id().alias(_SEQ))
    )
    # the ids are positional; freeze them in the shared checkpoint folder so a
    # recomputed task can never hand out different ones
    tagged = materialize(tagged, "rank-tagged")

    # 2. per (partition, group): first id and row count; offset = rows of the
    #    same group in earlier partitions. One row per (partition, group) pair,
    #    and a group has at most one per partition, so the window here is small.
    before = Window.partitionBy(*group_cols).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    renamed = {c: f"__g{i}" for i, c in enumerate(group_cols)}
    offsets = (
        tagged.groupBy(_PID, *group_cols)
        .agg(F.min(_SEQ).alias(_FIRST), F.count(F.lit(1)).alias(_CNT))
        .select(
            F.col(_PID).alias(_OPID),
            *[F.col(c).alias(renamed[c]) for c in group_cols],
            F.col(_FIRST),
            F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias(_OFF),
        )
    )
    # one row per (partition, group), written: Spark knows its size and broadcasts
    # it or joins on (partition, group), which spreads hot groups by partition
    offsets = materialize(offsets, "rank-offsets")

    cond = [F.col(_PID) == F.col(_OPID)] + [F.col(c).eqNullSafe(F.col(renamed[c])) for c in group_cols]
    ranked = tagged.join(offsets, cond, "inner").select(
        *[F.col(c) for c in df.columns],
        (F.col(_SEQ) - F.col(_FIRST) + F.col(_OFF) + 1).cast("int").alias(rank_col),
    )
    return ranked


def top_k_per_group(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[Column],
    k: int,
    rank_col: str = "rn",
) -> DataFrame:
    """First ``k`` rows per group by ``order_cols`` (with their rank)."""
    if k < 1:
        raise ValueError("k must be >= 1")
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
