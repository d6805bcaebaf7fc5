"""Deterministic de-duplication by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ROW = "__row"


def dedupe_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one row per ``keys``: the smallest by full row order (columns in order,
    NULL first).

    ``min`` is an ordinary aggregate, so Spark combines it map-side before the
    shuffle: a key holding a large share of the rows is reduced in every input
    task and reaches the reducer as one partial value per task.
    """
    keys = list(keys)
    # key columns come from the grouping key itself (equal to the struct's copy),
    # so the output keeps the aggregate's hash partitioning on ``keys`` and a
    # following join or aggregate on the same key needs no second shuffle
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*[F.col(c) for c in df.columns])).alias(_ROW))
        .select(*[F.col(c) if c in keys else F.col(f"{_ROW}.{c}").alias(c) for c in df.columns])
    )
