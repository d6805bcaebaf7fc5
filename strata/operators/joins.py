"""Joins with keys that cannot match."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_known_keys(left: DataFrame, right: DataFrame, key: str, balance_by: Sequence[str] = ()) -> DataFrame:
    """``left`` left-joined to ``right`` on ``key``, where rows of ``left`` without a key skip the join.

    In a shuffled left join every NULL key goes to one partition, though it can match
    nothing. Here these rows get NULLs for ``right``'s columns in a projection of their
    own and are united with the joined rest. ``left`` is read twice: this is meant for a
    stored table, whose row groups without NULL keys the second scan skips.

    ``balance_by``: the columns that ``left`` is stored by and the result will be. The
    join deals its rows anew, so they are rebalanced by these; the rest still
    lies as it was stored and is not shuffled at all.
    """
    joined = left.where(F.col(key).isNotNull()).join(right, key, "left")
    if balance_by:
        joined = joined.hint("rebalance", *balance_by)
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name != key]
    rest = left.where(F.col(key).isNull()).select("*", *missing)
    return joined.unionByName(rest)
