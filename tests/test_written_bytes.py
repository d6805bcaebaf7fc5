"""What the queries write and shuffle: compressed files, one shuffle where one is enough."""

from __future__ import annotations

import contextlib
import datetime
import io
import os

import pytest
from pyspark.sql import functions as F

from strata.plans import flows, registry
from strata.schemas import SERVING
from strata.session import scratch_path
from strata.sources import feeds


def plan_of(df) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain(extended=True)
    return out.getvalue()


def files(path, ending=""):
    return sorted(f for _, _, fs in os.walk(path) for f in fs if f.startswith("part-") and f.endswith(ending))


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """A few parts and orders; order 7 has no customer, and an order comes twice."""
    d = tmp_path_factory.mktemp("star")
    day = datetime.datetime(1999, 1, 5)
    parts = [(p, f"red blue {p}", f"Brand#{p % 3}", "SMALL TIN", p, 10.0) for p in range(1, 24)]
    orders = [(o, None if o == 7 else o % 5, "1-URGENT") for o in range(40)] + [(3, 4, "5-LOW")]
    lines = [
        (o, (o * 3 + n) % 25 + 1, (o + n) % 100 + 1, n + 1, float(o % 9), "N", "O", day + datetime.timedelta(days=o * 9 + n))
        for o in range(40) for n in range(1 + o % 4)
    ]
    tables = {
        "part": (parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "nation": ([(n, f"N{n}", n % 5) for n in range(25)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(r, f"R{r}") for r in range(5)], "r_regionkey int, r_name string"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderpriority string"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                            "l_returnflag string, l_linestatus string, l_shipdate timestamp"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    return str(d)


@pytest.fixture
def scratch(monkeypatch, tmp_path):
    """Where a query's own scratch folders lie: in ``tmp_path``, by name."""
    monkeypatch.setattr(registry, "scratch_path", lambda spark, name: str(tmp_path / name))
    return tmp_path


def same_rows(a, b):
    assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


# ---------------------------------------------------------------- incremental_fact_merge
def test_index_is_dealt_by_one_shuffle_and_ids_meet_by_hash(spark, star):
    from strata.streaming.locations import LocationIndex

    index = LocationIndex(scratch_path(spark, "t-index"), buckets=4)
    rows = [(f"r{i % 50}", "2020-01" if i % 3 else "2021-05") for i in range(90)] + [(None, "2020-02"), ("r1", None)]
    places = spark.createDataFrame(rows, "review_id string, ym string")
    dealt = plan_of(index._dealt(places)).split("== Physical Plan ==")[1]
    assert dealt.count("Exchange ") == 1
    index.build(places)
    same_rows(index.read(spark).select("review_id", "ym"), places.where("review_id IS NOT NULL").distinct())
    ids = spark.createDataFrame([("r1",), ("r999",), (None,)], "review_id string")
    months = index.months_of(ids)
    assert "hashpartitioning(review_id" not in plan_of(months) and "_hash" in plan_of(months)
    assert {r.ym for r in months.collect()} == {ym for i, ym in rows if i == "r1"}


def test_incremental_drops_are_gzipped_and_joined_once(spark, star, scratch):
    got = registry.q_incremental_fact_merge(spark, star)
    sent = spark.read.schema(registry.fact(spark, star).schema).json(str(scratch / "review-increment"))
    assert files(scratch / "review-increment") == files(scratch / "review-increment", ".gz")
    assert files(scratch / "review-fact") == files(scratch / "review-fact", ".zstd.parquet")
    again = sent.groupBy("review_id").agg(F.count("*").alias("n"), F.sum("funny").alias("f"))
    assert not again.isEmpty() and again.where("2 * f <> 3 * n").isEmpty()  # each once by either drop
    whole = registry.fact(spark, star).select("review_id").distinct()
    same_rows(got.select("review_id").distinct(), whole)
    assert got.where("funny = 2").select("review_id").distinct().count() >= again.count()


# ---------------------------------------------------------------- publishes
def check_publish(spark, star, scratch, query):
    got = query(spark, star)
    out = scratch / "publish-mart_review_fact_enriched"
    assert files(out, ".txt.gz") and not files(out, ".txt")
    n = spark.read.schema(SERVING["mart_review_fact_enriched"].schema).json(str(out)).count()
    assert n == registry.fact(spark, star).count()
    return got


def test_publish_fill_defaults_is_compressed_and_whole(spark, star, scratch):
    got = check_publish(spark, star, scratch, registry.q_publish_fill_defaults)
    contract = SERVING["mart_review_fact_enriched"].filled()
    from strata.sinks.publish import for_contract

    same_rows(got, for_contract(registry.q_mart_review_fact_enriched(spark, star), contract))


def test_publish_enriched_ndjson_is_compressed_and_whole(spark, star, scratch):
    got = check_publish(spark, star, scratch, registry.q_publish_enriched_ndjson)
    same_rows(got, registry.q_mart_review_fact_enriched(spark, star))


def test_publish_ranges_is_compressed_and_whole(spark, star, scratch):
    got = check_publish(spark, star, scratch, registry.q_publish_ranges)
    rows = registry.fact(spark, star).groupBy("ym").agg(F.count("*").alias("n_rows"))
    same_rows(got.select("ym", "n_rows"), rows)
    assert got.where("overlapping_files > 0").isEmpty()


def test_publish_audit_by_partition_is_compressed_and_whole(spark, star, scratch):
    got = check_publish(spark, star, scratch, registry.q_publish_audit_by_partition)
    rows = registry.fact(spark, star).groupBy(F.col("ym").alias("partition_value")).agg(F.count("*").alias("n"))
    same_rows(got.select("partition_value", F.col("rows_published").alias("n")), rows)
    assert got.where("rows_expected <> rows_published").isEmpty()


# ---------------------------------------------------------------- landing
def test_feed_in_parts_needs_no_shuffle_but_the_join(spark, star, scratch):
    feed = feeds.review_feed(spark, star, parts=7)
    same_rows(feed, feeds.review_feed(spark, star))
    assert "RoundRobinPartitioning" not in plan_of(feed) and feed.rdd.getNumPartitions() == 7
    got = registry.q_landing_rebalance(spark, star)
    src = files(scratch / "review-small")
    assert 1 < len(src) <= registry.SMALL_FILES and src == files(scratch / "review-small", ".gz")
    same_rows(got, registry.review_landing_df(spark, star))


# ---------------------------------------------------------------- marts
def test_rows_without_a_key_stay_where_the_fact_has_them(spark, star, scratch, monkeypatch):
    written = []
    write = flows.overwrite_parquet
    monkeypatch.setattr(flows, "overwrite_parquet", lambda df, *a, **b: (written.append((df, b)), write(df, *a, **b)))
    got = registry.q_mart_enriched_null_keys(spark, star)
    df, how = written[-1]
    assert how["balanced"] and how["partition_by"] == ("ym",)
    plan = plan_of(df).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert plan.count("RebalancePartitions") == 1 and plan.index("Union") < plan.index("RebalancePartitions")
    odd = F.split("review_id", "-")[1].cast("int") % 2 == 1
    full = registry.fact(spark, star)
    lacking = full.withColumn("business_id", F.when(odd, F.col("business_id")))
    want = registry.M.mart_review_fact_enriched(lacking, registry.core(spark, star))
    assert not got.where("business_id IS NULL").isEmpty()
    same_rows(got.select(*want.columns), want)


def test_landing_is_compressed_from_gzipped_input(spark, star, scratch):
    got = registry.q_external_landing_table(spark, star)
    assert files(scratch / "review-ndjson") and files(scratch / "review-ndjson") == files(scratch / "review-ndjson", ".gz")
    landed = scratch / "lake" / "landing" / "review_raw"
    assert files(landed) and files(landed) == files(landed, ".zstd.parquet")
    same_rows(got, registry.review_landing_df(spark, star))
