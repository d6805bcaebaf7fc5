"""Catalog tables, external tables over a path, session profiles."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.schemas import BUSINESS_CATEGORY, MART_BEST_CITY_AVG_RATE, REVIEW_FACT
from strata.session import PROFILES, build_session, ensure_checkpoint_dir, scratch_path
from strata.sinks.tables import overwrite_parquet, overwrite_partitions, save_table
from strata.sources.tables import read_month_slice, read_table, register_external


def test_save_table_keeps_declared_types(spark):
    df = spark.createDataFrame([("C", 2, 10, 4.5)], "city string, business_cnt int, total_reviews int, avg_business_rating double")
    spark.sql("CREATE DATABASE IF NOT EXISTS t_mart")
    save_table(df, "t_mart.best_city", MART_BEST_CITY_AVG_RATE)
    assert spark.table("t_mart.best_city").schema == MART_BEST_CITY_AVG_RATE
    with pytest.raises(ValueError):
        save_table(df.drop("city"), "t_mart.best_city", MART_BEST_CITY_AVG_RATE)
    assert read_table(spark, "t_mart.best_city").count() == 1


def test_external_table_over_path(spark):
    path = scratch_path(spark, "t-ext")
    overwrite_parquet(spark.createDataFrame([("b1", "Food")], "business_id string, category string"), path)
    register_external(spark, "t_ext_category", path, BUSINESS_CATEGORY)
    assert [tuple(r) for r in spark.table("t_ext_category").collect()] == [("b1", "Food")]
    assert read_table(spark, path).count() == 1


def test_partitioned_external_table_prunes(spark):
    path = scratch_path(spark, "t-ext-fact")
    rows = spark.range(0, 40).select(
        F.col("id").cast("string").alias("review_id"), F.lit("u").alias("user_id"), F.lit("b").alias("business_id"),
        F.lit(3).alias("stars"), F.lit(0).alias("useful"), F.lit(0).alias("funny"), F.lit(0).alias("cool"),
        F.lit(None).cast("timestamp_ntz").alias("review_date"),
        F.concat(F.lit("2020-0"), (F.col("id") % 4 + 1).cast("string")).alias("ym"),
    )
    overwrite_partitions(rows, path, "ym", REVIEW_FACT)
    sl = read_month_slice(spark, path, "2020-02", "2020-03", schema=REVIEW_FACT)
    assert sl.count() == 20
    register_external(spark, "t_ext_fact", path, REVIEW_FACT, partition_cols=("ym",))
    assert spark.table("t_ext_fact").where("ym = '2020-04'").count() == 10


def test_profiles_and_checkpoint_dir(spark):
    assert PROFILES["debug"]["spark.sql.adaptive.enabled"] == "false"
    assert PROFILES["mvp"]["spark.sql.adaptive.enabled"] == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert ensure_checkpoint_dir(spark)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    with pytest.raises(ValueError):
        build_session("x", profile="nope")


def test_library_stays_on_the_dataframe_api():
    """No UDFs, RDD code, local checkpoints or driver-side loops over data in the library."""
    import pathlib
    import re

    root = pathlib.Path(__file__).resolve().parents[1] / "strata"
    banned = re.compile(r"\budf\b|pandas_udf|\.rdd\b|localCheckpoint|toPandas|mapPartitions")
    # month keys in bounded lists; numbers of an index's buckets; two statuses; the first keys of a failed audit
    allowed_collect = {"streaming/incremental.py", "streaming/locations.py", "plans/landing.py", "sinks/publish.py"}
    engine = ("functions", "operators", "plans", "sinks", "sources", "streaming")
    for path in [*root.glob("*.py"), *(p for sub in engine for p in (root / sub).rglob("*.py"))]:
        text = path.read_text()
        rel = path.relative_to(root).as_posix()
        assert not banned.search(text), rel
        if ".collect()" in text:
            assert rel in allowed_collect, rel
