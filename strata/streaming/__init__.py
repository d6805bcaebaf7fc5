"""Structured Streaming: incremental file pickup merged into the partitioned fact."""

from strata.streaming.incremental import incremental_merge, merge_batch, start_incremental_merge

__all__ = ["incremental_merge", "merge_batch", "start_incremental_merge"]
