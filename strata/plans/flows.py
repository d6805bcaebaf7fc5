"""Job steps over a lakehouse layout: path-based (``Layout``) or catalog tables
(``CatalogLayout``).

Each step reads its inputs from the layout, builds its DataFrame(s) lazily
and writes them unless ``dry_run`` is set; it always returns what it built,
so a caller can inspect, count or explain it. Dependency order:

  business landing -> core split (core, category, attributes, hours)
      -> city x category rating, best city, top businesses, credit-card share
  review landing -> review fact (dynamic partition overwrite)
      -> monthly quality, enriched fact (also needs business core)
  each mart -> its publish
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from strata.operators.conform import cast_to_schema
from strata.operators.sanitize import sanitize_nan_inf
from strata.plans import core as C
from strata.plans import marts as M
from strata.plans.landing import land_ndjson, read_landing
from strata.plans.refresh import apply_changes
from strata.schemas import (
    BUSINESS_ATTRIBUTES,
    BUSINESS_CATEGORY,
    BUSINESS_CORE,
    BUSINESS_HOURS,
    LAYERS,
    PARTITIONED_TABLES,
    SERVING,
)
from strata.session import log_kv, scratch_owner
from strata.sinks.publish import PublishResult, for_contract, publish_partitioned, publish_rows, wire_format
from strata.sinks.tables import analyze_table, insert_overwrite_partitions, overwrite_parquet, overwrite_partitions, save_table
from strata.sinks.writers import materialize
from strata.sources.tables import read_if_exists, read_month_slice, read_table, register_external
from strata.streaming.incremental import PathFact, TableFact, in_parts, incremental_merge, months_slice


@dataclass(frozen=True)
class Layout:
    """Path-based lake: each table lives at ``{root}/{layer}/{table}``."""

    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        if layer == "landing":  # valid rows only; the quarantine sits beside them
            return read_landing(spark, _KIND[table], self.path(layer, table))
        schema = LAYERS[layer][table]
        return spark.read.schema(schema).parquet(self.path(layer, table))

    def write(self, df: DataFrame, layer: str, table: str, balanced: bool = False) -> None:
        """``balanced``: the rows already lie by the table's partition column."""
        part = PARTITIONED_TABLES.get(table)
        overwrite_parquet(df, self.path(layer, table), LAYERS[layer][table], partition_by=(part,) if part else (),
                          balanced=balanced)

    def replace_months(self, df: DataFrame, layer: str, table: str) -> None:
        """Replace the months present in ``df``, all others stay."""
        overwrite_partitions(df, self.path(layer, table), PARTITIONED_TABLES[table], LAYERS[layer][table])

    def fact_target(self) -> PathFact:
        return PathFact(self.path("core", "review_fact"))

    def drop_months(self, spark: SparkSession, layer: str, table: str, months: DataFrame) -> None:
        """Drop the month keys listed in ``months``."""
        for part in in_parts(months):
            PathFact(self.path(layer, table)).drop_months(spark, part)


@dataclass(frozen=True)
class CatalogLayout(Layout):
    """Catalog lake: the folders of a path layout, each with an external table
    ``{prefix}_{layer}.{table}`` of its declared types over it.

    As the data lies at fixed places, a catalog that ends with its process loses
    nothing: ``attach`` declares the tables again that are there. The fact is
    refreshed by positional, dynamic ``insertInto``. With ``statistics`` each written
    table is analyzed, for the cost-based choice of joins.
    """

    prefix: str
    statistics: bool = False

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}_{layer}.{table}"

    def attach(self, spark: SparkSession) -> list[str]:
        """Declare every written table that the catalog does not know."""
        return register_tables(spark, self, self.prefix, replace=False)

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        if layer == "landing":
            return super().read(spark, layer, table)
        return spark.table(self.name(layer, table)).select(*[f.name for f in LAYERS[layer][table].fields])

    def write(self, df: DataFrame, layer: str, table: str, balanced: bool = False) -> None:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}_{layer}")
        part = PARTITIONED_TABLES.get(table)
        save_table(df, self.name(layer, table), LAYERS[layer][table], path=self.path(layer, table),
                   partition_by=(part,) if part else (), balanced=balanced)
        if self.statistics:
            analyze_table(df.sparkSession, self.name(layer, table), JOINED_COLUMNS)

    def replace_months(self, df: DataFrame, layer: str, table: str) -> None:
        insert_overwrite_partitions(cast_to_schema(df, LAYERS[layer][table]), self.name(layer, table))
        if self.statistics:
            analyze_table(df.sparkSession, self.name(layer, table), JOINED_COLUMNS)

    def drop_months(self, spark: SparkSession, layer: str, table: str, months: DataFrame) -> None:
        for part in in_parts(months):
            TableFact(self.name(layer, table), self.path(layer, table)).drop_months(spark, part)

    def fact_target(self) -> TableFact:
        return TableFact(self.name("core", "review_fact"), self.path("core", "review_fact"))


#: columns that joins and filters use, of the tables that have them
JOINED_COLUMNS = ("business_id", "city", "category", "attribute_key")

_KIND = {"business_raw": "business", "review_raw": "review"}
AnyLayout = Layout


# ---------------------------------------------------------------- landing
def ingest_business(spark: SparkSession, src: str, layout: AnyLayout, dry_run: bool = False,
                    rebalance: bool = False) -> DataFrame:
    dst = layout.path("landing", "business_raw")
    log_kv(step="ingest", kind="business", src=src, dst=dst)
    if not dry_run:
        land_ndjson(spark, "business", src, dst, rebalance)
        return read_landing(spark, "business", dst)
    from strata.plans.landing import landing_from_ndjson

    return landing_from_ndjson(spark, "business", src)


def ingest_reviews(spark: SparkSession, src: str, layout: AnyLayout, dry_run: bool = False,
                   rebalance: bool = False) -> DataFrame:
    dst = layout.path("landing", "review_raw")
    log_kv(step="ingest", kind="review", src=src, dst=dst)
    if not dry_run:
        land_ndjson(spark, "review", src, dst, rebalance)
        return read_landing(spark, "review", dst)
    from strata.plans.landing import landing_from_ndjson

    return landing_from_ndjson(spark, "review", src)


# ---------------------------------------------------------------- core
def split_business(spark: SparkSession, layout: AnyLayout, dry_run: bool = False,
                   src_table: str | None = None) -> dict[str, DataFrame]:
    """Four writes, each scanning only the landing columns it needs."""
    landing = read_table(spark, src_table) if src_table else layout.read(spark, "landing", "business_raw")
    outputs = {
        "business_core": (C.business_core(landing), BUSINESS_CORE),
        "business_category": (C.business_category(landing), BUSINESS_CATEGORY),
        "business_attributes": (C.business_attributes(landing), BUSINESS_ATTRIBUTES),
        "business_hours": (C.business_hours(landing), BUSINESS_HOURS),
    }
    for name, (df, _schema) in outputs.items():
        log_kv(step="write", table=name, dry_run=dry_run)
        if not dry_run:
            layout.write(df, "core", name)
    return {name: df for name, (df, _) in outputs.items()}


def refresh_businesses(spark: SparkSession, layout: AnyLayout, src: str, removed: DataFrame | None = None) -> None:
    """Take in a feed of changed businesses (NDJSON; all listings of each) and drop the ``removed`` ids:
    core tables and city marts follow, from the changed businesses alone (``plans.refresh``)."""
    from strata.plans.landing import landing_from_ndjson

    log_kv(step="refresh", kind="business", src=src)
    with scratch_owner(spark):
        apply_changes(spark, layout, landing_from_ndjson(spark, "business", src), removed)


def write_review_fact(spark: SparkSession, layout: AnyLayout, dry_run: bool = False,
                      src_table: str | None = None, dst_table: str | None = None) -> DataFrame:
    """Refresh only the months present in the landing extract (dynamic partition overwrite).
    ``src_table`` (a table name or path of landing rows) replaces the layout's own, ``dst_table``
    (a table name, or a path with a '/') the fact that is written."""
    landing = read_table(spark, src_table) if src_table else layout.read(spark, "landing", "review_raw")
    fact = C.review_fact(landing)
    log_kv(step="write", table="review_fact", mode="dynamic", dry_run=dry_run)
    if not dry_run:
        target = layout.fact_target() if not dst_table else PathFact(dst_table) if "/" in dst_table else TableFact(dst_table)
        target.reload_months(fact)
    return fact


def merge_review_increment(spark: SparkSession, increment_dir: str, layout: AnyLayout, stream_checkpoint: str,
                           max_files_per_trigger: int | None = None) -> DataFrame:
    """Pick up new review files and merge them into the fact (availableNow stream)."""
    return incremental_merge(spark, increment_dir, layout.fact_target(), stream_checkpoint, max_files_per_trigger)


# ---------------------------------------------------------------- marts
def build_mart(spark: SparkSession, name: str, layout: AnyLayout, dry_run: bool = False,
               ym_from: str | None = None, ym_to: str | None = None,
               src_table: str | None = None, dst_table: str | None = None) -> DataFrame:
    """Build (and unless ``dry_run`` write) one mart by name.

    ``ym_from`` / ``ym_to`` refresh those months of a month-partitioned mart from
    a pruned fact scan and leave the others; a month of the range that the fact no
    longer has is dropped. Of the monthly mart, later months in which a delta
    follows from the range are patched (``marts.refreshed_months``).
    ``src_table`` replaces the mart's first input, ``dst_table`` its destination
    (table names, or paths with a '/'). A dry run writes nothing at all: of the
    ranking, whose steps are written, it returns the rows to be ranked.
    """
    if (ym_from or ym_to) and name not in PARTITIONED_TABLES:
        raise ValueError(f"{name} has no months to refresh")
    first = {"mart_city_category_rating": "business_core", "mart_best_city_avg_rate": "business_core",
             "mart_top_businesses_per_category": "business_core", "mart_category_creditcard_share": "business_category"}

    def core(t: str) -> DataFrame:
        if src_table and t == first.get(name, "review_fact"):
            return read_table(spark, src_table).select(*[f.name for f in LAYERS["core"][t].fields])
        return layout.read(spark, "core", t)

    def fact() -> DataFrame:
        return read_month_slice(spark, core("review_fact"), ym_from, ym_to)

    def monthly() -> DataFrame:
        if ym_from or ym_to:  # for another destination: the months of the range alone
            return M.refreshed_months(core("review_fact"), layout.read(spark, "mart", name), ym_from, ym_to)[0]
        return M.mart_business_quality_monthly(core("review_fact"))

    # a mart laid out by month as its stored fact is: rows that no join has dealt anew stay where they lie
    aligned = name == "mart_review_fact_enriched" and not (dry_run or ym_from or ym_to or src_table or dst_table)
    stored_by = (PARTITIONED_TABLES[name],) if aligned else ()

    builders = {
        "mart_city_category_rating": lambda: M.mart_city_category_rating(core("business_core"),
                                                                         core("business_category")),
        "mart_best_city_avg_rate": lambda: M.mart_best_city_avg_rate(core("business_core"), unique=not src_table),
        "mart_top_businesses_per_category": lambda: (
            M.ranking_input if dry_run else M.mart_top_businesses_per_category
        )(core("business_core"), core("business_category")),
        "mart_category_creditcard_share": lambda: M.mart_category_creditcard_share(
            core("business_category"), core("business_attributes")),
        "mart_business_quality_monthly": monthly,
        "mart_review_fact_enriched": lambda: M.mart_review_fact_enriched(fact(), core("business_core"), stored=True,
                                                                         balance_by=stored_by),
    }
    if name not in builders:
        raise ValueError(f"unknown mart {name!r}; expected one of {sorted(builders)}")
    log_kv(step="write", table=name, dry_run=dry_run)
    ranged = ym_from or ym_to
    if ranged and name == "mart_business_quality_monthly" and not dst_table:
        with scratch_owner(spark):
            stored = layout.read(spark, "mart", name)
            months, patched = M.refreshed_months(core("review_fact"), stored, ym_from, ym_to)
            if dry_run:
                return months.unionByName(patched)
            _replace_range(spark, layout, name, stored, months, patched, ym_from, ym_to)
        return layout.read(spark, "mart", name)
    if dry_run:
        return builders[name]()
    with scratch_owner(spark):
        df = builders[name]()
        if dst_table and "/" in dst_table:
            overwrite_parquet(df, dst_table, LAYERS["mart"][name])
        elif dst_table:
            save_table(df, dst_table, LAYERS["mart"][name])
        elif ranged:
            stored = layout.read(spark, "mart", name)
            _replace_range(spark, layout, name, stored, df.where(M.in_months(ym_from, ym_to)), None, ym_from, ym_to)
        else:
            layout.write(df, "mart", name, balanced=aligned)
    return read_table(spark, dst_table) if dst_table else layout.read(spark, "mart", name)


def _replace_range(spark: SparkSession, layout: AnyLayout, name: str, stored: DataFrame, months: DataFrame,
                   patched: DataFrame | None, ym_from: str | None, ym_to: str | None) -> None:
    """Put ``months`` in place of the stored months of the range, and the rows ``patched`` (by business
    and month) in place of theirs; only months that hold one of these are written."""
    months = materialize(months, "mart-months")
    if patched is not None:
        patched = materialize(patched, "mart-patched")
        touched = months_slice(stored, patched.select("ym").distinct())
        kept = touched.join(patched.select("business_id", "ym"), ["business_id", "ym"], "left_anti")
        both = months.unionByName(kept.select(*months.columns)).unionByName(patched.select(*months.columns))
        written = materialize(both, "mart-refreshed")
    else:
        written = months
    had = stored.where(M.in_months(ym_from, ym_to)).select("ym").distinct()
    gone = materialize(had.join(months.select("ym").distinct(), "ym", "left_anti"), "mart-gone")
    if not written.isEmpty():
        layout.replace_months(written, "mart", name)
    layout.drop_months(spark, "mart", name, gone)


# ---------------------------------------------------------------- publish
def publish_mart(
    spark: SparkSession,
    name: str,
    layout: AnyLayout,
    publish_root: str,
    batch_rows: int | None = None,
    truncate: bool = True,
    dry_run: bool = False,
    fill_type_defaults: bool = False,
    audit: bool = True,
    src_table: str | None = None,
    dst_table: str | None = None,
    manifest: bool = False,
    ranges: bool = False,
) -> PublishResult | int:
    """Publish a mart per its serving contract; ``dry_run`` only counts the rows.

    Rows take the contract's columns and wire types, checked before anything is
    written. ``fill_type_defaults`` writes the type's default instead of omitting NULL
    fields, i.e. what a non-null serving column would show anyway. ``audit`` reads
    the published files back to check the row count (a full read of the output).
    ``src_table`` (a table name or path) replaces the mart as the input, ``dst_table``
    its folder under ``publish_root``; ``manifest`` and ``ranges`` as in ``publish_partitioned``.
    """
    contract = SERVING[name].filled() if fill_type_defaults else SERVING[name]
    df = read_table(spark, src_table) if src_table else layout.read(spark, "mart", name)
    if name == "mart_business_quality_monthly":
        df = sanitize_nan_inf(df)
    df = for_contract(df, contract)
    if dry_run:
        n = df.count()
        log_kv(publish=name, mode="dry", rows=n)
        return n
    dst = f"{publish_root.rstrip('/')}/{dst_table or name}"
    if contract.partition_col:
        return publish_partitioned(wire_format(df), dst, table=name, partition_col=contract.partition_col,
                                   sort_key=contract.sort_key, batch_rows=batch_rows, truncate=truncate,
                                   audit=audit, manifest=manifest, ranges=ranges)
    return publish_rows(df.sortWithinPartitions(*contract.sort_key), dst, table=name,
                        batch_rows=batch_rows, truncate=truncate, audit=audit)


MARTS = list(LAYERS["mart"])


def register_tables(spark: SparkSession, layout: Layout, prefix: str = "strata", replace: bool = True) -> list[str]:
    """Declare every written table of the layout in the catalog as ``{prefix}_{layer}.{table}``
    (external tables over the layout's folders), so they can be queried with SQL.
    ``replace`` declares those again that the catalog has already."""
    registered = []
    for layer, tables in LAYERS.items():
        db = f"{prefix}_{layer}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
        for table, schema in tables.items():
            path = layout.path(layer, table)
            if layer == "landing":
                path = f"{path}/_landing_status=valid"
            if read_if_exists(spark, path, schema) is None:  # not written yet
                continue
            if spark.catalog.tableExists(f"{db}.{table}"):
                if not replace:
                    continue
                spark.sql(f"DROP TABLE {db}.{table}")
            part = PARTITIONED_TABLES.get(table)
            register_external(spark, f"{db}.{table}", path, schema, partition_cols=(part,) if part else ())
            registered.append(f"{db}.{table}")
    return registered
