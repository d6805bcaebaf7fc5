"""Table contracts for every layer: raw read schemas, landing, core, marts, serving.

Raw feeds are read with an explicit schema in which every scalar is STRING:
no inference pass over the input, missing keys come back as NULL, and the
typed conversion happens afterwards with ``try_cast`` so one bad value only
nulls that value instead of marking the whole line corrupt.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
L = T.LongType()
D = T.DoubleType()
TS = T.TimestampNTZType()  # wall-clock timestamps, independent of the session zone


def struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


CORRUPT_COL = "_corrupt_record"

# ---- fixed values: column names, types and partition columns of every table down to
# ---- the serving contracts; the data's contract, which must stay as written
# ---------------------------------------------------------------- raw (NDJSON)
BUSINESS_FIELDS = [
    "business_id", "name", "address", "city", "state", "postal_code",
    "latitude", "longitude", "stars", "review_count", "is_open",
    "attributes", "categories", "hours",
]
REVIEW_FIELDS = ["review_id", "user_id", "business_id", "stars", "useful", "funny", "cool", "text", "date"]

BUSINESS_RAW_READ = struct(*[(c, S) for c in BUSINESS_FIELDS])
REVIEW_RAW_READ = struct(*[(c, S) for c in REVIEW_FIELDS])

# ---------------------------------------------------------------- landing
BUSINESS_LANDING = struct(
    ("business_id", S), ("name", S), ("address", S), ("city", S), ("state", S), ("postal_code", S),
    ("latitude", D), ("longitude", D), ("stars", D), ("review_count", I), ("is_open", I),
    ("attributes", S), ("categories", S), ("hours", S),
)
REVIEW_LANDING = struct(
    ("review_id", S), ("user_id", S), ("business_id", S),
    ("stars", I), ("useful", I), ("funny", I), ("cool", I),
    ("text", S), ("review_date", TS),
)

# ---------------------------------------------------------------- core
BUSINESS_CORE = struct(
    ("business_id", S), ("name", S), ("address", S), ("city", S), ("state", S), ("postal_code", S),
    ("latitude", D), ("longitude", D), ("stars", D), ("review_count", I), ("is_open", I),
)
BUSINESS_CATEGORY = struct(("business_id", S), ("category", S))
BUSINESS_ATTRIBUTES = struct(("business_id", S), ("attribute_key", S), ("attribute_value", S))
BUSINESS_HOURS = struct(
    ("business_id", S), ("day_of_week", S),
    ("open_hour", I), ("open_minute", I), ("close_hour", I), ("close_minute", I),
    ("open_minutes", I), ("close_minutes", I),
)
REVIEW_FACT = struct(
    ("review_id", S), ("user_id", S), ("business_id", S),
    ("stars", I), ("useful", I), ("funny", I), ("cool", I),
    ("review_date", TS), ("ym", S),
)
FACT_PARTITION_COL = "ym"

# ---------------------------------------------------------------- marts
MART_CITY_CATEGORY_RATING = struct(("city", S), ("category", S), ("business_count", L), ("avg_rating", D))
MART_TOP_BUSINESSES_PER_CATEGORY = struct(
    ("business_id", S), ("name", S), ("category", S), ("city", S),
    ("stars", D), ("review_count", I), ("rn", I),
)
MART_CATEGORY_CREDITCARD_SHARE = struct(
    ("category", S), ("businesses_with_info", L), ("accepting_credit_cards", L), ("acceptance_level_pct", D),
)
MART_BUSINESS_QUALITY_MONTHLY = struct(
    ("business_id", S), ("ym", S), ("avg_rating", D), ("review_cnt", L), ("rating_delta", D),
)
MART_BEST_CITY_AVG_RATE = struct(
    ("city", S), ("business_cnt", L), ("total_reviews", L), ("avg_business_rating", D),
)
MART_REVIEW_FACT_ENRICHED = struct(
    ("review_id", S), ("ym", S), ("review_date", TS),
    ("business_id", S), ("business_name", S), ("city", S), ("state", S),
    ("latitude", D), ("longitude", D), ("is_open", I),
    ("business_stars", D), ("business_review_count", I),
    ("user_id", S), ("review_stars", I), ("useful", I), ("funny", I), ("cool", I),
)


# ---------------------------------------------------------------- serving contracts
@dataclass(frozen=True)
class ServingContract:
    """What the serving store expects for one published table.

    ``unsigned``: columns it stores without a sign. ``non_null``: columns it
    declares without NULLs, filled with the default of their type when
    a publish asks for it (and always shown so by the store).
    """

    name: str
    schema: T.StructType
    sort_key: tuple[str, ...]
    partition_col: str | None = None
    unsigned: tuple[str, ...] = ()
    non_null: tuple[str, ...] = ()

    @staticmethod
    def default(field: T.StructField) -> object:
        """The store's default for a type: empty text, zero, the epoch."""
        if isinstance(field.dataType, T.StringType):
            return ""
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return "1970-01-01 00:00:00"
        return 0

    def filled(self) -> ServingContract:
        """The contract with every column non-null, as the store declares them."""
        return replace(self, non_null=tuple(f.name for f in self.schema.fields))


# fixed values: sort keys, partition columns and unsigned columns of the serving tables
SERVING: dict[str, ServingContract] = {
    c.name: c
    for c in [
        ServingContract("mart_city_category_rating", MART_CITY_CATEGORY_RATING, ("city", "category"), unsigned=("business_count",)),
        ServingContract(
            "mart_top_businesses_per_category", MART_TOP_BUSINESSES_PER_CATEGORY,
            ("category", "rn", "stars", "business_id"),
        ),
        ServingContract("mart_category_creditcard_share", MART_CATEGORY_CREDITCARD_SHARE, ("category",),
                        unsigned=("businesses_with_info", "accepting_credit_cards")),
        ServingContract(
            "mart_business_quality_monthly", MART_BUSINESS_QUALITY_MONTHLY, ("business_id", "ym"), "ym",
            unsigned=("review_cnt",),
        ),
        ServingContract("mart_best_city_avg_rate", MART_BEST_CITY_AVG_RATE, ("city",),
                        unsigned=("business_cnt", "total_reviews")),
        ServingContract(
            "mart_review_fact_enriched", MART_REVIEW_FACT_ENRICHED,
            ("business_id", "review_date", "review_id"), "ym",
            unsigned=("is_open", "business_review_count"),
        ),
    ]
}

# Catalog layout: layer database -> tables it holds, in creation order.
LAYERS: dict[str, dict[str, T.StructType]] = {
    "landing": {"business_raw": BUSINESS_LANDING, "review_raw": REVIEW_LANDING},
    "core": {
        "business_core": BUSINESS_CORE,
        "business_category": BUSINESS_CATEGORY,
        "business_hours": BUSINESS_HOURS,
        "business_attributes": BUSINESS_ATTRIBUTES,
        "review_fact": REVIEW_FACT,
    },
    "mart": {
        "mart_city_category_rating": MART_CITY_CATEGORY_RATING,
        "mart_top_businesses_per_category": MART_TOP_BUSINESSES_PER_CATEGORY,
        "mart_category_creditcard_share": MART_CATEGORY_CREDITCARD_SHARE,
        "mart_business_quality_monthly": MART_BUSINESS_QUALITY_MONTHLY,
        "mart_best_city_avg_rate": MART_BEST_CITY_AVG_RATE,
        "mart_review_fact_enriched": MART_REVIEW_FACT_ENRICHED,
    },
}
PARTITIONED_TABLES: dict[str, str] = {
    "review_fact": FACT_PARTITION_COL,
    "mart_business_quality_monthly": "ym",
    "mart_review_fact_enriched": "ym",
}
