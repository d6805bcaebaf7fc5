"""Named queries over the star-schema test tables, one per inventory operator.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame. The raw
feeds are projected from the given tables (``sources.feeds``), so every query
reads whole tables and its work grows with them. Queries that exercise a
write path (NDJSON scan, dynamic partition overwrite, publish, streaming
merge) write to a fresh folder under the shared checkpoint directory and
return what they read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import clean_attribute_key
from strata.operators.generators import explode_json_map
from strata.operators.sanitize import sanitize_nan_inf
from strata.plans import core as C
from strata.plans import flows
from strata.plans import marts as M
from strata.plans.landing import (
    STATUS_COL,
    VALID,
    business_landing,
    compact_landing,
    land_ndjson,
    landing_from_ndjson,
    read_landing,
    read_quarantine,
    review_landing,
)
from strata.schemas import BUSINESS_CORE, CORRUPT_COL, REVIEW_FACT, SERVING
from strata.session import scratch_path
from strata.sinks.publish import audited_partitions, for_contract, publish_partitioned, publish_rows, read_published, wire_format
from strata.sinks.tables import (
    create_layers,
    drop_layers,
    insert_overwrite_partitions,
    overwrite_parquet,
    overwrite_partitions,
    save_table,
)
from strata.sinks.writers import materialize, write_ndjson
from strata.sources import feeds
from strata.sources.tables import read_if_exists, read_month_slice
from strata.streaming.incremental import incremental_merge

# ---- fixed parameters of the test queries ------------------------------------
MONTH_SLICE = ("1997-01", "1997-12")          # fact_month_slice
RELOAD_MONTHS = ("1998-01", "1998-12")        # dynamic_partition_overwrite
INCREMENT_FROM = "1999-07-01"                 # incremental_fact_merge: reviews sent again from this date (in the id)
REVISED_MONTHS = ("1997-06", "1997-08")       # mart_month_refresh
TOP_K = 3
SMALL_FILES = 40                              # landing_rebalance
CHANGED_EVERY = 7                             # mart_city_refresh: businesses that change
PUBLISH_RANGES = 200                          # publish_ranges: more than there are months
PUBLISH_CODEC = "gzip"                        # files of the partitioned publishes
# ------------------------------------------------------------------------------


# ---------------------------------------------------------------- shared inputs
def entity_landing(spark: SparkSession, sf: str) -> DataFrame:
    return business_landing(feeds.as_raw_strings(feeds.entity_feed(spark, sf)))


def review_landing_df(spark: SparkSession, sf: str) -> DataFrame:
    return review_landing(feeds.as_raw_strings(feeds.review_feed(spark, sf)))


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return C.review_fact(review_landing_df(spark, sf))


def core(spark: SparkSession, sf: str) -> DataFrame:
    return C.business_core(entity_landing(spark, sf))


def category(spark: SparkSession, sf: str) -> DataFrame:
    return C.business_category(entity_landing(spark, sf))


def attributes(spark: SparkSession, sf: str) -> DataFrame:
    return C.business_attributes(entity_landing(spark, sf))


# ---------------------------------------------------------------- scans / landing
def q_json_scan_conform(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "entity-ndjson")
    write_ndjson(feeds.entity_feed(spark, sf), path)
    return landing_from_ndjson(spark, "business", path)


def q_conform_entity(spark: SparkSession, sf: str) -> DataFrame:
    return entity_landing(spark, sf)


def q_review_landing(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "review-ndjson")
    write_ndjson(feeds.review_feed(spark, sf), path)
    return landing_from_ndjson(spark, "review", path)


# ---------------------------------------------------------------- core
def q_business_core(spark: SparkSession, sf: str) -> DataFrame:
    return core(spark, sf)


def q_business_category(spark: SparkSession, sf: str) -> DataFrame:
    return category(spark, sf)


def q_business_attributes(spark: SparkSession, sf: str) -> DataFrame:
    return attributes(spark, sf)


def q_clean_attribute_key(spark: SparkSession, sf: str) -> DataFrame:
    kv = explode_json_map(entity_landing(spark, sf), "business_id", "attributes", "raw_key", "raw_value")
    return kv.groupBy("raw_key").agg(F.count(F.lit(1)).alias("n")).select(
        "raw_key", clean_attribute_key("raw_key").alias("attribute_key"), "n"
    )


def q_event_props_kv(spark: SparkSession, sf: str) -> DataFrame:
    events = feeds.table(spark, sf, "events")
    return explode_json_map(events, "event_id", "props", "prop_key", "prop_value")


def q_business_hours(spark: SparkSession, sf: str) -> DataFrame:
    return C.business_hours(entity_landing(spark, sf))


def q_review_fact(spark: SparkSession, sf: str) -> DataFrame:
    return fact(spark, sf)


def q_fact_month_slice(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "review-fact")
    overwrite_parquet(fact(spark, sf), path, REVIEW_FACT, partition_by=["ym"])
    return read_month_slice(spark, path, *MONTH_SLICE, schema=REVIEW_FACT)


def q_dynamic_partition_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "review-fact")
    full = fact(spark, sf)
    overwrite_parquet(full, path, REVIEW_FACT, partition_by=["ym"])
    # second load: a corrected extract of some months (fewer rows, new vote counts)
    reload = (
        full.where(F.col("ym").between(*RELOAD_MONTHS) & (F.col("stars") >= 3))
        .withColumn("useful", F.col("useful") + 1000)
    )
    overwrite_partitions(reload, path, "ym", REVIEW_FACT)
    return spark.read.schema(REVIEW_FACT).parquet(path)


# ---------------------------------------------------------------- marts
def q_mart_city_category_rating(spark: SparkSession, sf: str) -> DataFrame:
    return M.mart_city_category_rating(core(spark, sf), category(spark, sf))


def q_mart_best_city_avg_rate(spark: SparkSession, sf: str) -> DataFrame:
    return M.mart_best_city_avg_rate(core(spark, sf))


def q_mart_business_quality_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return M.mart_business_quality_monthly(fact(spark, sf))


def q_mart_review_fact_enriched(spark: SparkSession, sf: str) -> DataFrame:
    return M.mart_review_fact_enriched(fact(spark, sf), core(spark, sf))


def q_mart_top_businesses_per_category(spark: SparkSession, sf: str) -> DataFrame:
    return M.mart_top_businesses_per_category(core(spark, sf), category(spark, sf))


def q_top_k_per_category(spark: SparkSession, sf: str) -> DataFrame:
    return M.top_businesses_per_category(core(spark, sf), category(spark, sf), TOP_K)


def q_mart_category_creditcard_share(spark: SparkSession, sf: str) -> DataFrame:
    return M.mart_category_creditcard_share(category(spark, sf), attributes(spark, sf))


# ---------------------------------------------------------------- publish
def q_sanitize_nan_inf(spark: SparkSession, sf: str) -> DataFrame:
    ev = feeds.table(spark, sf, "events").select("event_id", "event_type", "value")
    # a score that is not finite for some event types, as a faulty upstream would send
    score = (
        F.when(F.col("event_type") == "error", F.lit(float("nan")))
        .when(F.col("event_type") == "click", F.lit(float("inf")))
        .when(F.col("event_type") == "signup", F.lit(float("-inf")))
        .otherwise(F.col("value"))
    )
    return sanitize_nan_inf(ev.select("event_id", "event_type", "value", score.alias("score")))


def q_publish_rows_ndjson(spark: SparkSession, sf: str) -> DataFrame:
    contract = SERVING["mart_city_category_rating"]
    path = scratch_path(spark, "publish-" + contract.name)
    publish_rows(q_mart_city_category_rating(spark, sf), path, table=contract.name)
    return read_published(spark, path, contract.schema)


def q_publish_partitioned_ndjson(spark: SparkSession, sf: str) -> DataFrame:
    contract = SERVING["mart_business_quality_monthly"]
    path = scratch_path(spark, "publish-" + contract.name)
    mart = sanitize_nan_inf(q_mart_business_quality_monthly(spark, sf))
    publish_partitioned(mart, path, table=contract.name, partition_col=contract.partition_col,
                        sort_key=contract.sort_key, compression=PUBLISH_CODEC)
    return read_published(spark, path, contract.schema)


def q_publish_enriched_ndjson(spark: SparkSession, sf: str) -> DataFrame:
    return _published_enriched(spark, sf, SERVING["mart_review_fact_enriched"])


def _published_enriched(spark: SparkSession, sf: str, contract) -> DataFrame:
    path = scratch_path(spark, "publish-" + contract.name)
    mart = wire_format(for_contract(q_mart_review_fact_enriched(spark, sf), contract))
    publish_partitioned(mart, path, table=contract.name, partition_col=contract.partition_col,
                        sort_key=contract.sort_key, compression=PUBLISH_CODEC)
    # an empty partition value has the folder of NULL; the contract says which it was
    return for_contract(read_published(spark, path, contract.schema), contract)


def q_publish_fill_defaults(spark: SparkSession, sf: str) -> DataFrame:
    return _published_enriched(spark, sf, SERVING["mart_review_fact_enriched"].filled())


def q_publish_append(spark: SparkSession, sf: str) -> DataFrame:
    contract = SERVING["mart_best_city_avg_rate"]
    path = scratch_path(spark, "publish-" + contract.name)
    mart = for_contract(q_mart_best_city_avg_rate(spark, sf), contract)
    publish_rows(mart, path, table=contract.name)
    res = publish_rows(mart, path, table=contract.name, truncate=False)
    published = read_published(spark, path, contract.schema).agg(F.count(F.lit(1)).alias("rows_published"))
    return published.select(
        F.lit(res.table).alias("table_name"), F.lit(res.rows_written).cast("bigint").alias("rows_written"),
        F.lit(res.rows_read_back).cast("bigint").alias("rows_read_back"), "rows_published",
    )


def q_publish_audit(spark: SparkSession, sf: str) -> DataFrame:
    contract = SERVING["mart_best_city_avg_rate"]
    path = scratch_path(spark, "publish-" + contract.name)
    res = publish_rows(q_mart_best_city_avg_rate(spark, sf), path, table=contract.name)
    return spark.createDataFrame(
        [(res.table, res.rows_written, res.rows_read_back)],
        "table_name string, rows_written bigint, rows_read_back bigint",
    )


def q_publish_audit_by_partition(spark: SparkSession, sf: str) -> DataFrame:
    """The enriched fact is published with a manifest: rows of each month as counted before and as read back."""
    contract = SERVING["mart_review_fact_enriched"]
    path = scratch_path(spark, "publish-" + contract.name)
    mart = materialize(wire_format(for_contract(q_mart_review_fact_enriched(spark, sf), contract)), "mart")
    publish_partitioned(mart, path, table=contract.name, partition_col=contract.partition_col,
                        sort_key=contract.sort_key, manifest=True, compression=PUBLISH_CODEC)
    return audited_partitions(spark, path, contract.partition_col)


def q_publish_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """The enriched fact is published by ranges: per month its rows, first and last sort key, and how
    many of its files overlap another of them (none)."""
    contract = SERVING["mart_review_fact_enriched"]
    path = scratch_path(spark, "publish-" + contract.name)
    mart = materialize(wire_format(for_contract(q_mart_review_fact_enriched(spark, sf), contract)), "mart")
    publish_partitioned(mart, path, table=contract.name, partition_col=contract.partition_col,
                        sort_key=contract.sort_key, ranges=PUBLISH_RANGES, compression=PUBLISH_CODEC)
    key = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in contract.sort_key])
    rows = spark.read.schema(contract.schema).json(path).select("ym", F.input_file_name().alias("file"), key.alias("key"))
    files = rows.groupBy("ym", "file").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first"), F.max("key").alias("last"))
    before = F.max("last").over(Window.partitionBy("ym").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1))
    files = files.withColumn("overlaps", F.coalesce((before >= F.col("first")).cast("long"), F.lit(0)))
    return files.groupBy("ym").agg(
        F.sum("n").alias("n_rows"), F.sum("overlaps").alias("overlapping_files"),
        F.min("first.business_id").alias("first_business"), F.max("last.business_id").alias("last_business"),
    )


# ---------------------------------------------------------------- streaming
def q_incremental_fact_merge(spark: SparkSession, sf: str) -> DataFrame:
    """All reviews are in the fact; those from INCREMENT_FROM on come again in two
    file drops, the newer one final, some of them moved to a later month."""
    fact_path = scratch_path(spark, "review-fact")
    inc_dir = scratch_path(spark, "review-increment")
    overwrite_parquet(fact(spark, sf), fact_path, REVIEW_FACT, partition_by=["ym"])
    key = F.split("review_id", "-")
    again = feeds.review_feed(spark, sf).where(key[4] >= INCREMENT_FROM.replace("-", ""))
    when = F.col("date").try_cast("timestamp")
    moved = F.date_format(when + F.expr("INTERVAL 40 DAYS"), "yyyy-MM-dd HH:mm:ss")
    write_ndjson(again.withColumn("funny", F.lit(1)), inc_dir)
    again = spark.read.schema(again.schema).json(inc_dir)  # the older drop has the rows: they are not joined again
    write_ndjson(
        again.withColumns({"funny": F.lit(2), "date": F.when(key[1] == "2", moved).otherwise(F.col("date"))}), inc_dir, mode="append"
    )
    return incremental_merge(spark, inc_dir, fact_path, scratch_path(spark, "stream-ckpt"))


# ---------------------------------------------------------------- quarantine, catalog, refresh
def q_json_scan_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Lines cut short among the good ones: all are kept beside the landed rows."""
    feed = feeds.entity_feed(spark, sf)
    lines = feed.select(F.to_json(F.struct(*feed.columns)).alias("value"))
    cut = feeds.table(spark, sf, "part").where("p_size % 9 = 0").select(
        F.concat(F.lit('{"business_id":"'), F.col("p_partkey").cast("string"), F.lit('","name":"'), "p_name").alias("value")
    )
    src, dst = scratch_path(spark, "raw-lines"), scratch_path(spark, "landing")
    lines.unionByName(cut).write.text(src)
    land_ndjson(spark, "business", src, dst)
    return read_quarantine(spark, dst, "business")


def q_conform_missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    raw = feeds.as_raw_strings(feeds.entity_feed(spark, sf))
    return business_landing(raw.drop("address", "postal_code", "latitude", "review_count", "hours"))


def _catalog(spark: SparkSession) -> tuple[str, str]:
    return f"q_{uuid.uuid4().hex[:10]}", scratch_path(spark, "lake")


def q_catalog_table_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    prefix, root = _catalog(spark)
    layout = flows.CatalogLayout(root, prefix)
    full = materialize(fact(spark, sf), "catalog-extract")
    layout.fact_target().replace_months(full)
    # every month comes again without its low ratings
    layout.fact_target().replace_months(full.where("stars >= 3 OR stars IS NULL"))
    drop_layers(spark, prefix)  # the data stays where it is; declaring it again finds it
    layout.attach(spark)
    result = materialize(layout.read(spark, "core", "review_fact"), "catalog-fact")
    drop_layers(spark, prefix)
    return result


def q_external_landing_table(spark: SparkSession, sf: str) -> DataFrame:
    prefix, root = _catalog(spark)
    create_layers(spark, prefix, location=root, landing_root=f"{root}/landing")
    src = scratch_path(spark, "review-ndjson")
    write_ndjson(feeds.review_feed(spark, sf), src)
    land_ndjson(spark, "review", src, f"{root}/landing/review_raw")
    spark.catalog.refreshTable(f"{prefix}_landing.review_raw")
    result = materialize(spark.table(f"{prefix}_landing.review_raw"), "external-landing")
    drop_layers(spark, prefix)
    return result


def q_create_drop_layers(spark: SparkSession, sf: str) -> DataFrame:
    prefix, root = _catalog(spark)
    db = create_layers(spark, prefix, location=root)["core"]
    insert_overwrite_partitions(fact(spark, sf), f"{db}.review_fact")
    counts = materialize(spark.table(f"{db}.review_fact").groupBy("ym").agg(F.count(F.lit(1)).alias("n")), "months")
    drop_layers(spark, prefix)
    return counts.withColumn("left_after_drop", F.lit(spark.catalog.databaseExists(db)))


def q_mart_month_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Some months of the fact are revised; refreshing the mart from there equals a full rebuild."""
    layout = flows.Layout(scratch_path(spark, "lake"))
    full = fact(spark, sf)
    layout.fact_target().replace_months(full)
    flows.build_mart(spark, "mart_business_quality_monthly", layout)
    revised = full.where(F.col("ym").between(*REVISED_MONTHS)).withColumn("stars", 6 - F.col("stars"))
    layout.fact_target().replace_months(revised)
    return flows.build_mart(spark, "mart_business_quality_monthly", layout, ym_from=REVISED_MONTHS[0], ym_to=REVISED_MONTHS[1])


def q_mart_enriched_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The enriched mart of a stored fact that lacks the business of every other line."""
    layout = flows.Layout(scratch_path(spark, "lake"))
    even = F.split("review_id", "-")[1].cast("int") % 2 == 0
    full = fact(spark, sf)
    layout.fact_target().replace_months(full.withColumn("business_id", F.when(~even, F.col("business_id"))))
    layout.write(core(spark, sf), "core", "business_core")
    return flows.build_mart(spark, "mart_review_fact_enriched", layout)


def q_landing_rebalance(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews landed from very many small files; compacting them keeps every row."""
    src, dst = scratch_path(spark, "review-small"), scratch_path(spark, "landing")
    write_ndjson(feeds.review_feed(spark, sf, parts=SMALL_FILES), src)
    small = landing_from_ndjson(spark, "review", src).select("*", F.lit(None).cast("string").alias(CORRUPT_COL), F.lit(VALID).alias(STATUS_COL))
    small.repartition(SMALL_FILES).write.partitionBy(STATUS_COL).parquet(dst)
    compact_landing(spark, "review", dst)
    return read_landing(spark, "review", dst)


def q_catalog_save_table(spark: SparkSession, sf: str) -> DataFrame:
    """A managed table written by ``saveAsTable`` twice; the second write replaces the first."""
    prefix, root = _catalog(spark)
    db = create_layers(spark, prefix, location=root)["core"]
    save_table(core(spark, sf).where("stars > 3"), f"{db}.business_core", BUSINESS_CORE)
    save_table(core(spark, sf), f"{db}.business_core", BUSINESS_CORE)
    result = materialize(spark.table(f"{db}.business_core"), "saved-core")
    drop_layers(spark, prefix)
    return result


def q_publish_dry_run(spark: SparkSession, sf: str) -> DataFrame:
    """Dry runs of two publishes: the rows they would write, and that nothing is written."""
    layout = flows.Layout(scratch_path(spark, "lake"))
    target = scratch_path(spark, "publish-dry")
    layout.write(core(spark, sf), "core", "business_core")
    layout.write(category(spark, sf), "core", "business_category")
    rows = []
    for name in ("mart_best_city_avg_rate", "mart_city_category_rating"):
        flows.build_mart(spark, name, layout)
        rows.append((name, flows.publish_mart(spark, name, layout, target, dry_run=True)))
    left = read_if_exists(spark, target, T.StructType([T.StructField("value", T.StringType())]), "text")
    counted = spark.createDataFrame(rows, "table_name string, rows_counted bigint")
    return counted.withColumn("written", F.lit(left is not None))


def _moved_feed(spark: SparkSession, sf: str) -> DataFrame:
    """All listings of the businesses that change: other ratings, and some in another city or category."""
    feed = feeds.entity_feed(spark, sf).where(F.col("business_id").cast("long") % CHANGED_EVERY == 0)
    moved = F.col("business_id").cast("long") % 2 == 0
    return feed.withColumns({
        "stars": (F.lit(6) - F.col("stars")), "city": F.when(moved, "NEWTOWN").otherwise(F.col("city")),
        "categories": F.when(moved, F.concat(F.coalesce("categories", F.lit("plain")), F.lit(", moved"))).otherwise(F.col("categories")),
    })


def _refreshed_businesses(spark: SparkSession, sf: str) -> flows.Layout:
    layout = flows.Layout(scratch_path(spark, "lake"))
    src, changes = scratch_path(spark, "entity-ndjson"), scratch_path(spark, "entity-changes")
    write_ndjson(feeds.entity_feed(spark, sf), src)
    flows.ingest_business(spark, src, layout)
    flows.split_business(spark, layout)
    write_ndjson(_moved_feed(spark, sf), changes)
    flows.refresh_businesses(spark, layout, changes)
    return layout


def q_mart_city_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Every seventh business changes; the city x category mart follows from these alone."""
    return _refreshed_businesses(spark, sf).read(spark, "mart", "mart_city_category_rating")


def q_mart_best_city_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """The same changes in the mart by city."""
    return _refreshed_businesses(spark, sf).read(spark, "mart", "mart_best_city_avg_rate")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "json_scan_conform": q_json_scan_conform,
    "conform_entity": q_conform_entity,
    "review_landing": q_review_landing,
    "business_core": q_business_core,
    "business_category": q_business_category,
    "business_attributes": q_business_attributes,
    "clean_attribute_key": q_clean_attribute_key,
    "event_props_kv": q_event_props_kv,
    "business_hours": q_business_hours,
    "review_fact": q_review_fact,
    "fact_month_slice": q_fact_month_slice,
    "dynamic_partition_overwrite": q_dynamic_partition_overwrite,
    "mart_city_category_rating": q_mart_city_category_rating,
    "mart_best_city_avg_rate": q_mart_best_city_avg_rate,
    "mart_business_quality_monthly": q_mart_business_quality_monthly,
    "mart_review_fact_enriched": q_mart_review_fact_enriched,
    "mart_top_businesses_per_category": q_mart_top_businesses_per_category,
    "top_k_per_category": q_top_k_per_category,
    "mart_category_creditcard_share": q_mart_category_creditcard_share,
    "sanitize_nan_inf": q_sanitize_nan_inf,
    "publish_rows_ndjson": q_publish_rows_ndjson,
    "publish_partitioned_ndjson": q_publish_partitioned_ndjson,
    "publish_enriched_ndjson": q_publish_enriched_ndjson,
    "publish_audit": q_publish_audit,
    "incremental_fact_merge": q_incremental_fact_merge,
    "json_scan_quarantine": q_json_scan_quarantine,
    "conform_missing_columns": q_conform_missing_columns,
    "publish_fill_defaults": q_publish_fill_defaults,
    "publish_append": q_publish_append,
    "catalog_table_overwrite": q_catalog_table_overwrite,
    "external_landing_table": q_external_landing_table,
    "create_drop_layers": q_create_drop_layers,
    "mart_month_refresh": q_mart_month_refresh,
    "publish_audit_by_partition": q_publish_audit_by_partition,
    "publish_ranges": q_publish_ranges,
    "mart_enriched_null_keys": q_mart_enriched_null_keys,
    "landing_rebalance": q_landing_rebalance,
    "catalog_save_table": q_catalog_save_table,
    "publish_dry_run": q_publish_dry_run,
    "mart_city_refresh": q_mart_city_refresh,
    "mart_best_city_refresh": q_mart_best_city_refresh,
}
