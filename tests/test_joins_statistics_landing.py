"""Rows without a join key, stored statistics, sizes of landed files, distinct counts of foreign tables."""

from __future__ import annotations

import json
import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators.joins import left_join_known_keys
from strata.plans import flows
from strata.plans import marts as M
from strata.plans.landing import compact_landing, land_ndjson, landed_files, landing_report, read_landing, read_quarantine
from strata.session import scratch_path
from strata.sinks.tables import analyze_table, save_table
from tests.test_skew import conf, core_for, skewed_fact

SHUFFLED = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_without_a_key_skip_the_join(spark):
    path = scratch_path(spark, "t-fact")
    fact = skewed_fact(spark).withColumn("business_id", F.when(F.col("review_id").cast("int") % 2 == 0, F.col("business_id")))
    fact.write.parquet(path)
    fact, core = spark.read.parquet(path), core_for(spark)
    with conf(spark, **SHUFFLED, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        df = M.mart_review_fact_enriched(fact, core, stored=True)
        plan = plan_of(df)
        union = plan[plan.index("Union") :]
        branch = union[union.rindex("isnull(business_id") :]  # from the filter of the second branch on
        assert "Exchange" not in branch and "IsNull(business_id)" in branch
        # no task of the shuffle gets the half without a key
        joined = left_join_known_keys(fact, core.select("business_id", "city"), "business_id")
        assert joined.count() == 30000 and joined.where("business_id IS NULL AND city IS NULL").count() == 15000
        plain = M.mart_review_fact_enriched(fact, core)
        assert df.exceptAll(plain).isEmpty() and plain.exceptAll(df).isEmpty()
        tasks = joined.where("business_id IS NOT NULL").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert tasks < 15000


def test_stored_statistics_change_the_join(spark):
    """The filter keeps a few rows of the dimension; only column statistics let Spark know before it runs."""
    db = f"t_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'db')}'")
    try:
        dim = spark.range(40_000).select(F.col("id").alias("k"), (F.col("id") % 4000).cast("string").alias("city"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        save_table(dim, f"{db}.dim")
        save_table(spark.range(200_000).select((F.col("id") % 40_000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("x")), f"{db}.fact")

        def joined():
            return spark.table(f"{db}.fact").join(spark.table(f"{db}.dim").where("city = '17'"), "k")

        with conf(spark, **{"spark.sql.cbo.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "100k", "spark.sql.adaptive.enabled": "false"}):
            assert "SortMergeJoin" in plan_of(joined())
            before = sorted(map(tuple, joined().collect()))
            for t in ("dim", "fact"):
                analyze_table(spark, f"{db}.{t}", ["k", "city"])
            assert "BroadcastHashJoin" in plan_of(joined())
            assert sorted(map(tuple, joined().collect())) == before and len(before) == 50
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")


def test_catalog_layout_stores_statistics(spark):
    prefix = f"t_{uuid.uuid4().hex[:8]}"
    layout = flows.CatalogLayout(scratch_path(spark, "t-lake"), prefix, statistics=True)
    layout.write(core_for(spark), "core", "business_core")
    name = layout.name("core", "business_core")
    said = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert "998 rows" in said["Statistics"]
    column = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name} business_id").collect()}
    assert int(column["distinct_count"]) > 900
    spark.sql(f"DROP DATABASE {prefix}_core CASCADE")


def test_small_landed_files_are_reported_and_compacted(spark, tmp_path):
    src, dst = tmp_path / "src", scratch_path(spark, "t-landing")
    src.mkdir()
    for i in range(30):
        lines = [json.dumps({"review_id": f"r{i}-{k}", "business_id": "b", "stars": 3, "date": "2020-01-01"}) for k in range(5)]
        (src / f"{i:02d}.json").write_text("\n".join([*lines, "BROKEN" if i % 10 == 0 else lines[0]]))
    with conf(spark, **{"spark.sql.files.maxPartitionBytes": "500", "spark.sql.files.openCostInBytes": "500"}):
        land_ndjson(spark, "review", str(src), dst)
    rows = sorted(map(str, read_landing(spark, "review", dst).collect()))
    bad = sorted(map(str, read_quarantine(spark, dst, "review").collect()))
    report = {r["status"]: r for r in landing_report(spark, dst, 1 << 20).collect()}
    assert report["valid"]["small"] == report["valid"]["files"] > 10 and report["valid"]["wanted"] == 1 and report["valid"]["large"] == 0
    assert report["valid"]["bytes"] == landed_files(spark, dst).where("status = 'valid'").agg(F.sum("bytes")).first()[0]
    assert "content" not in landed_files(spark, dst).columns
    assert compact_landing(spark, "review", dst, 1 << 20) == ["quarantine", "valid"]
    assert {r["status"]: r["files"] for r in landing_report(spark, dst, 1 << 20).collect()} == {"valid": 1, "quarantine": 1}
    assert sorted(map(str, read_landing(spark, "review", dst).collect())) == rows
    assert sorted(map(str, read_quarantine(spark, dst, "review").collect())) == bad and len(bad) == 3
    assert compact_landing(spark, "review", dst, 1 << 20) == []  # nothing is left to do
    assert compact_landing(spark, "review", dst, 100) == []  # files above the target are not small


def test_foreign_tables_count_distinct_businesses(spark):
    layout = flows.Layout(scratch_path(spark, "t-lake"))
    core = core_for(spark)
    twice = scratch_path(spark, "t-foreign")
    core.unionByName(core.where("business_id = 'hot'")).write.parquet(twice)
    got = flows.build_mart(spark, "mart_best_city_avg_rate", layout, src_table=twice).first()
    assert got["business_cnt"] == 998 and got["total_reviews"] == 999
    assert "count(distinct" not in M.mart_best_city_avg_rate(core)._jdf.queryExecution().optimizedPlan().toString()


def test_other_destinations_of_fact_and_publish(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.json").write_text(json.dumps({"review_id": "r", "business_id": "b", "stars": 3, "date": "2020-01-01"}))
    layout = flows.Layout(scratch_path(spark, "t-lake"))
    flows.ingest_reviews(spark, str(src), layout)
    other = scratch_path(spark, "t-other")
    flows.write_review_fact(spark, layout, dst_table=other)
    assert spark.read.parquet(other).count() == 1
    flows.build_mart(spark, "mart_business_quality_monthly", layout, src_table=other)
    root = scratch_path(spark, "t-published")
    res = flows.publish_mart(spark, "mart_business_quality_monthly", layout, root, dst_table="monthly_v2", manifest=True, ranges=True)
    assert res.path == f"{root}/monthly_v2" and res.rows_read_back == 1


@pytest.mark.parametrize("text,want", [("3.0", 3), ("3", 3), (" 7 ", 7), ("-2.9", -2), ("5d", None), ("99999999999", None), ("1e3", 1000), ("", None), ("x", None), ("+4", 4)])
def test_integers_by_the_form_of_the_text(spark, text, want):
    from strata.functions.columns import to_int

    assert spark.createDataFrame([(text,)], "t string").select(to_int("t")).first()[0] == want


def test_decimal_text_costs_no_more_than_a_double_cast(spark):
    import time

    from strata.functions.columns import to_int

    path = scratch_path(spark, "t-text")
    spark.range(400_000).select(F.concat((F.col("id") % 5).cast("string"), F.lit(".0")).alias("t")).write.parquet(path)

    def best(c):
        times = []
        for _ in range(3):
            start = time.time()
            spark.read.parquet(path).select(c.alias("x")).agg(F.sum("x")).collect()
            times.append(time.time() - start)
        return min(times)

    assert best(to_int("t")) < 2 * best(F.col("t").try_cast("double")) + 0.5
