"""Core layer: the landing entity split into normalised tables, and the
month-keyed review fact.

Each function is a lazy transform. The four entity outputs read only the
columns they need, so each scan is pruned to 11, 2, 2 and 2 columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import year_month
from strata.operators.dedupe import dedupe_by_key
from strata.operators.generators import explode_json_map, explode_list, explode_time_ranges
from strata.schemas import BUSINESS_CORE, REVIEW_FACT

CORE_COLUMNS = [f.name for f in BUSINESS_CORE.fields]


def business_core(landing: DataFrame) -> DataFrame:
    """One row per ``business_id`` (the smallest full row when a business repeats)."""
    return dedupe_by_key(landing.select(*CORE_COLUMNS), ["business_id"])


def business_category(landing: DataFrame) -> DataFrame:
    """(business_id, category) per list element; blanks dropped, repeats kept."""
    return explode_list(landing, "business_id", "categories", "category")


def business_attributes(landing: DataFrame) -> DataFrame:
    """(business_id, attribute_key, attribute_value); keys cleaned of repr quoting.
    Entries with a NULL value are kept (landing has already dropped them)."""
    return explode_json_map(
        landing, "business_id", "attributes", "attribute_key", "attribute_value", clean_keys=True
    )


def business_hours(landing: DataFrame) -> DataFrame:
    """One row per business and day with parsed opening and closing times."""
    return explode_time_ranges(landing, "business_id", "hours", "day_of_week")


def review_fact(review_landing: DataFrame, passthrough: Sequence[str] = ()) -> DataFrame:
    """Reviews without their text, keyed by month ``ym`` (last, the partition column;
    ``passthrough`` columns follow unchanged)."""
    return review_landing.select(
        *[F.col(f.name) for f in REVIEW_FACT.fields if f.name != "ym"],
        year_month("review_date").alias("ym"),
        *passthrough,
    )
