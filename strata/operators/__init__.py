"""Relational operators (DataFrame in, DataFrame out)."""

from strata.operators.conform import cast_to_schema, conform
from strata.operators.dedupe import dedupe_by_key
from strata.operators.generators import explode_json_map, explode_list, explode_time_ranges
from strata.operators.joins import left_join_known_keys
from strata.operators.ranking import rank_within_groups, top_k_per_group
from strata.operators.sanitize import fill_defaults, sanitize_nan_inf

__all__ = [
    "cast_to_schema",
    "conform",
    "dedupe_by_key",
    "explode_json_map",
    "explode_list",
    "explode_time_ranges",
    "fill_defaults",
    "left_join_known_keys",
    "rank_within_groups",
    "sanitize_nan_inf",
    "top_k_per_group",
]
