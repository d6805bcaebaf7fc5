"""A key holding a third of all rows: results stay whole and the hot key is split."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from strata.operators.dedupe import dedupe_by_key
from strata.plans import marts as M


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def skewed_fact(spark, n=30000):
    bid = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string"))
    return spark.range(0, n).select(
        F.col("id").cast("string").alias("review_id"), F.lit("u").alias("user_id"), bid.alias("business_id"),
        (F.col("id") % 5 + 1).cast("int").alias("stars"), F.lit(0).alias("useful"), F.lit(0).alias("funny"),
        F.lit(0).alias("cool"), F.lit(None).cast("timestamp_ntz").alias("review_date"),
        F.concat(F.lit("2020-"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0")).alias("ym"),
    )


def core_for(spark):
    ids = spark.range(0, 997).select(F.col("id").cast("string").alias("business_id")).union(
        spark.createDataFrame([("hot",)], "business_id string"))
    return ids.select("business_id", F.lit("n").alias("name"), F.lit("a").alias("address"), F.lit("c").alias("city"),
                      F.lit("s").alias("state"), F.lit("1").alias("postal_code"), F.lit(1.0).alias("latitude"),
                      F.lit(1.0).alias("longitude"), F.lit(4.0).alias("stars"), F.lit(1).alias("review_count"),
                      F.lit(1).alias("is_open"))


def test_enriched_join_splits_hot_key(spark):
    fact, core = skewed_fact(spark), core_for(spark)
    with conf(spark, **{
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }):
        df = M.mart_review_fact_enriched(fact, core)
        assert df.count() == 30000
        df._jdf.queryExecution().toRdd().count()  # runs this frame's own adaptive plan
        jvm = spark.sparkContext._jvm
        plan = df._jdf.queryExecution().explainString(jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        assert "skew=true" in plan
        assert df.where(F.col("business_name").isNull()).count() == 0


def test_monthly_and_dedupe_on_hot_key(spark):
    fact = skewed_fact(spark)
    monthly = M.mart_business_quality_monthly(fact)
    assert monthly.agg(F.sum("review_cnt")).first()[0] == 30000
    hot = monthly.where(F.col("business_id") == "hot")
    # hot ids are multiples of 3, so they fall in months 1, 4, 7 and 10
    assert sorted(r.ym for r in hot.collect()) == ["2020-01", "2020-04", "2020-07", "2020-10"]
    assert hot.agg(F.sum("review_cnt")).first()[0] == 10000
    assert dedupe_by_key(fact, ["business_id"]).count() == 998


def test_heavy_month_is_written_by_several_tasks(spark):
    import os
    import re

    from strata.schemas import REVIEW_FACT
    from strata.session import scratch_path
    from strata.sinks.tables import overwrite_partitions

    fact = skewed_fact(spark).withColumn(
        "ym", F.when(F.col("review_id").cast("int") % 3 == 0, F.lit("2020-01")).otherwise(F.col("ym")))
    path = scratch_path(spark, "t-hot-month")
    with conf(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                        "spark.sql.adaptive.coalescePartitions.enabled": "true"}):
        overwrite_partitions(fact, path, "ym", REVIEW_FACT)
    hot = os.path.join(path.removeprefix("file:"), "ym=2020-01")
    tasks = {re.match(r"part-(\d+)", f).group(1) for f in os.listdir(hot) if f.startswith("part-")}
    assert len(tasks) > 1
    assert spark.read.parquet(path).count() == 30000
