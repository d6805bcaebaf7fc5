"""Raw entity and review feeds derived from the star-schema test tables.

The engine's real inputs are NDJSON entity (business) and review files. The
test tables are a parts/orders star schema, so these functions project them
into the same raw shape, row for row, with a fixed rule that the DuckDB
oracle restates in SQL. Every row of ``part`` becomes a business and every
row of ``lineitem`` a review, so the work grows with the tables.

Entity feed (``part`` joined to ``nation`` on ``p_partkey % 25`` and ``region``):
  a part whose size is a multiple of 10 is listed twice, the second time with
  an upper-case name, to exercise de-duplication; ``attributes`` and
  ``hours`` are maps (``NULL`` values kept, as a raw file would carry them).
Review feed (``lineitem`` joined to ``orders``): one review per line item. As in
raw files, some rows are flawed, none is dropped: dates that do not parse
(``l_suppkey % 97 = 0``) or carry a UTC offset (line 3, 23:30 at -05:00), an
unknown business (``l_partkey % 53 = 0``), an absent key ``cool``
(``o_custkey % 11 = 0``) and a number with a type suffix (``l_suppkey % 89 = 0``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import BUSINESS_FIELDS, REVIEW_FIELDS

# ---- fixed values of the feed rule (restated in the oracle SQL) ------------
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday"]
CREDIT_CARD_KEY = "BusinessAcceptsCreditCards"
BRAND_KEY_SPELLINGS = ["Brand", "'Brand'", "u'Brand'", '"Brand"']  # chosen by p_partkey % 4
PRICE_KEY = "RestaurantsPriceRange2"
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _entry(key: Column | str, value: Column) -> Column:
    k = F.lit(key) if isinstance(key, str) else key
    return F.struct(k.alias("key"), value.cast("string").alias("value"))


def _map_of(*entries: Column) -> Column:
    """Map from (key, value) entries; an entry whose key is NULL is left out."""
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["key"].isNotNull()))


def entity_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw businesses with JSON-like types (numbers, nested maps)."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    geo = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    p = part.join(geo, (F.col("p_partkey") % 25) == F.col("n_nationkey"))
    size, key = F.col("p_size"), F.col("p_partkey")
    p = p.withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(size % 10 == 0, 1).otherwise(0))))

    words = F.replace(F.col("p_name"), F.lit(" "), F.lit(", "))
    categories = (
        F.when(size % 11 == 0, F.lit(None).cast("string"))
        .when(size % 6 == 0, F.concat(words, F.lit(", "), F.col("p_type"), F.lit(", , "),
                                      F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))))
        .otherwise(F.concat(words, F.lit(", "), F.col("p_type")))
    )

    credit = F.when(size % 3 == 0, F.lit(None)).when(size % 2 == 0, F.lit("True")).otherwise(F.lit("False"))
    brand_key = F.element_at(F.array(*[F.lit(s) for s in BRAND_KEY_SPELLINGS]), (key % 4 + 1).cast("int"))
    attributes = F.when(size % 13 == 0, F.lit(None)).otherwise(
        _map_of(
            _entry(CREDIT_CARD_KEY, credit),
            _entry(brand_key, F.col("p_brand")),
            _entry(PRICE_KEY, size % 4 + 1),
        )
    )

    open_h = size % 6 + 6
    open_m = (key % 4) * 15
    close_h = (open_h + 8 + size % 12) % 24
    close_m = (size % 2) * 30
    rng = F.concat_ws("", open_h.cast("string"), F.lit(":"), open_m.cast("string"), F.lit("-"),
                      close_h.cast("string"), F.lit(":"), close_m.cast("string"))
    saturday = F.when(size % 2 == 0, F.lit("0:0-0:0")).otherwise(rng)
    sunday_key = F.when(size % 5 <= 1, F.lit("Sunday"))
    sunday = F.when(size % 5 == 0, F.lit("closed"))
    hours = F.when(size % 7 == 0, F.lit(None)).otherwise(
        _map_of(*[_entry(d, rng) for d in WEEKDAYS], _entry("Saturday", saturday), _entry(sunday_key, sunday))
    )

    out = p.select(
        key.cast("string").alias("business_id"),
        F.when(F.col("copy") == 1, F.upper("p_name")).otherwise(F.col("p_name")).alias("name"),
        F.concat(F.col("p_brand"), F.lit(" Ave")).alias("address"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.lpad((key % 100000).cast("string"), 5, "0").alias("postal_code"),
        ((key % 180).cast("double") - 89.5).alias("latitude"),
        ((key % 360).cast("double") - 179.75).alias("longitude"),
        (F.lit(1.0) + (size % 9) * 0.5).alias("stars"),
        (key % 500).alias("review_count"),
        (key % 2).alias("is_open"),
        attributes.alias("attributes"),
        categories.alias("categories"),
        hours.alias("hours"),
    )
    return out.select(*BUSINESS_FIELDS)


def review_feed(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Raw reviews with JSON-like types; ``stars`` is a float such as 3.0. ``parts``: the
    number of partitions; the join itself deals the rows to them, by order."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    if parts:
        li, orders = li.repartition(parts, "l_orderkey"), orders.repartition(parts, "o_orderkey")
    r = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    s = lambda c: F.col(c).cast("string")
    out = r.select(
        F.concat_ws("-", s("l_orderkey"), s("l_linenumber"), s("l_partkey"), s("l_suppkey"),
                    F.date_format("l_shipdate", "yyyyMMdd")).alias("review_id"),
        s("o_custkey").alias("user_id"),
        F.when(F.col("l_partkey") % 53 == 0, F.concat(F.lit("x"), s("l_partkey"))).otherwise(s("l_partkey")).alias("business_id"),
        (F.lit(1.0) + F.col("l_quantity") % 5).alias("stars"),
        F.when(F.col("l_suppkey") % 89 == 0, "5d").otherwise((F.col("l_linenumber") - 1).cast("string")).alias("useful"),
        (F.col("l_suppkey") % 3).alias("funny"),
        F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey") % 4).alias("cool"),
        F.concat_ws(" ", F.lit("order"), F.col("o_orderpriority"), F.lit("flag"),
                    F.col("l_returnflag"), F.col("l_linestatus")).alias("text"),
        F.when(F.col("l_suppkey") % 97 == 0, "not a date")
        .when(F.col("l_linenumber") == 3, F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("T23:30:00-05:00")))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("date"),
    ).select(*REVIEW_FIELDS)
    return out.coalesce(parts) if parts else out  # where the session shuffles to more


def as_raw_strings(df: DataFrame) -> DataFrame:
    """The same rows as an all-STRING read of their NDJSON would give:
    numbers as their literal text, maps/structs as compact JSON text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.dataType.typeName() in ("map", "struct", "array"):
            cols.append(F.to_json(c).alias(f.name))
        else:
            cols.append(c.cast("string").alias(f.name))
    return df.select(*cols)
