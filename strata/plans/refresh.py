"""City marts kept by change: mergeable partial aggregates of businesses.

Beside the marts lie two tables of partials: per city, and per (city, category),
the number of businesses and the exact sums behind the averages. When businesses
change, the partials of their old rows are taken off and those of their new rows
added; only changed businesses are joined and aggregated, never the whole core. The
marts are projections of the partials.

A distinct count is mergeable because a business counts once a group: its
old row takes one off, its new row adds one, whatever its listings.

Sums of stars are decimals of six places, so that taking off what was added leaves
nothing behind; a rating that no such decimal holds (NaN, infinite) is counted
apart and makes the group's average NaN while it is there. A group with no business left is
dropped; NULL cities are a group of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans import core as C
from strata.schemas import MART_BEST_CITY_AVG_RATE, MART_CITY_CATEGORY_RATING
from strata.sinks.writers import materialize
from strata.sources.tables import read_if_exists

PARTIALS = {"city": ["city"], "city_category": ["city", "category"]}
_MEASURES = ("businesses", "rows_n", "reviews", "reviews_n", "stars", "stars_n", "odd_n")
_SUM = "decimal(28,6)"


def _measures() -> list[F.Column]:
    """Partial sums over rows of a business (once a group) with ``review_count``, ``stars`` and how often it is listed (``n``)."""
    exact = F.col("stars").try_cast("decimal(18,6)")
    odd = F.col("stars").isNotNull() & (exact.isNull() | (exact.cast("double") != F.col("stars")))
    return [
        F.count("business_id").alias("businesses"),
        F.count(F.lit(1)).alias("rows_n"),
        F.sum(F.col("review_count").cast("long")).alias("reviews"),
        F.sum(F.col("review_count").isNotNull().cast("long")).alias("reviews_n"),
        F.sum(F.when(~odd, exact * F.col("n").cast("decimal(9,0)"))).cast(_SUM).alias("stars"),
        F.sum(F.when(F.col("stars").isNotNull() & ~odd, F.col("n")).otherwise(0)).cast("long").alias("stars_n"),
        F.sum(F.when(odd, F.col("n")).otherwise(0)).cast("long").alias("odd_n"),
    ]


def partials(core: DataFrame, category: DataFrame) -> dict[str, DataFrame]:
    """The partials of these businesses (each once in ``core``) and their categories."""
    by_city = core.select("business_id", "city", "review_count", "stars", F.lit(1).alias("n")).groupBy("city").agg(*_measures())
    # a category listed twice weighs twice in the average and once in the count
    listed = category.groupBy("business_id", "category").agg(F.count(F.lit(1)).alias("n"))
    joined = listed.join(core.select("business_id", "city", "review_count", "stars"), "business_id")
    by_both = joined.groupBy("city", "category").agg(*_measures())
    return {"city": by_city, "city_category": by_both}


def merged(state: DataFrame, added: DataFrame, taken: DataFrame, keys: list[str]) -> DataFrame:
    """``state`` with partials added and taken off: one row a group from each side."""
    less = taken.select(*keys, *[F.negative(F.col(m)).alias(m) for m in _MEASURES])
    sums = [F.coalesce(F.sum(m), F.lit(0)).cast(_SUM if m == "stars" else "long").alias(m) for m in _MEASURES]
    return state.unionByName(added).unionByName(less).groupBy(*keys).agg(*sums).where("rows_n > 0")


def mart_of(name: str, state: DataFrame) -> DataFrame:
    """The mart that a table of partials stands for."""
    average = F.when(F.col("odd_n") > 0, float("nan")).when(F.col("stars_n") > 0, F.col("stars").cast("double") / F.col("stars_n"))
    if name == "city":
        total = F.when(F.col("reviews_n") > 0, F.col("reviews"))
        cols = ["city", F.col("businesses").alias("business_cnt"), total.alias("total_reviews"), average.alias("avg_business_rating")]
        return state.select(*cols).select(*MART_BEST_CITY_AVG_RATE.names)
    return state.select("city", "category", F.col("businesses").alias("business_count"), average.alias("avg_rating")).select(
        *MART_CITY_CATEGORY_RATING.names
    )


def changed_tables(landing: DataFrame) -> dict[str, DataFrame]:
    """The core tables of changed businesses, from their landing rows."""
    return {
        "business_core": C.business_core(landing), "business_category": C.business_category(landing),
        "business_attributes": C.business_attributes(landing), "business_hours": C.business_hours(landing),
    }


def apply_changes(spark: SparkSession, layout, landing: DataFrame, removed: DataFrame | None = None) -> None:
    """Replace the businesses that ``landing`` lists (all rows of each) and drop the ``removed`` ids, in the
    core tables, the partials and the two city marts of ``layout``. Rows without an id change nothing."""
    landing = landing.where("business_id IS NOT NULL")
    fresh = {name: materialize(df, "changed-" + name) for name, df in changed_tables(landing).items()}
    ids = fresh["business_core"].select("business_id")
    ids = materialize(ids if removed is None else ids.unionByName(removed.select("business_id")).distinct(), "changed-ids")
    old = {name: layout.read(spark, "core", name) for name in fresh}
    state = read_partials(spark, layout)
    if state is None:  # the first time, from all businesses
        state = {k: materialize(df, "partials") for k, df in partials(old["business_core"], old["business_category"]).items()}
    gone = partials(old["business_core"].join(ids, "business_id", "left_semi"), old["business_category"].join(ids, "business_id", "left_semi"))
    new = partials(fresh["business_core"], fresh["business_category"])
    after = {k: materialize(merged(state[k], new[k], gone[k], keys), "partials-" + k) for k, keys in PARTIALS.items()}
    tables = {name: materialize(df.join(ids, "business_id", "left_anti").unionByName(fresh[name].select(*df.columns)), name) for name, df in old.items()}
    for name, df in tables.items():
        layout.write(df, "core", name)
    for k, df in after.items():
        df.write.mode("overwrite").parquet(partials_path(layout, k))
    layout.write(mart_of("city", after["city"]), "mart", "mart_best_city_avg_rate")
    layout.write(mart_of("city_category", after["city_category"]), "mart", "mart_city_category_rating")


def partials_path(layout, name: str) -> str:
    return f"{layout.root.rstrip('/')}/partials/{name}"


def read_partials(spark: SparkSession, layout) -> dict[str, DataFrame] | None:
    """The stored partials, or None before the first change."""
    found = {}
    for name, keys in PARTIALS.items():
        fields = [T.StructField(k, T.StringType()) for k in keys]
        fields += [T.StructField(m, T.DecimalType(28, 6) if m == "stars" else T.LongType()) for m in _MEASURES]
        found[name] = read_if_exists(spark, partials_path(layout, name), T.StructType(fields))
    return None if any(df is None for df in found.values()) else found
