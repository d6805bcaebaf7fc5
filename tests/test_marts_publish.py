"""Marts, writes, publish and the incremental merge on small hand-made frames."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.ranking import rank_within_groups, top_k_per_group
from strata.operators.sanitize import fill_defaults, sanitize_nan_inf
from strata.plans import marts as M
from strata.schemas import REVIEW_FACT, SERVING
from strata.session import scratch_path
from strata.sinks.publish import PublishAuditError, publish_partitioned, publish_rows, read_published
from strata.sinks.tables import create_layers, drop_layers, insert_overwrite_partitions, overwrite_partitions
from strata.sinks.writers import write_ndjson
from strata.streaming.incremental import incremental_merge, merge_batch

FACT_DDL = ("review_id string, user_id string, business_id string, stars int, useful int, funny int, cool int, "
            "review_date timestamp_ntz, ym string")


def fact_rows(spark, rows):
    out = []
    for rid, bid, stars, ymd in rows:
        ts = dt.datetime.strptime(ymd, "%Y-%m-%d") if ymd else None
        out.append((rid, "u", bid, stars, 0, 0, 0, ts, ts.strftime("%Y-%m") if ts else None))
    return spark.createDataFrame(out, FACT_DDL)


def test_monthly_delta_against_previous_present_month(spark):
    f = fact_rows(spark, [("r1", "b1", 2, "2020-01-05"), ("r2", "b1", 4, "2020-01-06"),
                          ("r3", "b1", 5, "2020-04-01"), ("r4", "b2", 1, "2020-04-01")])
    rows = {(r.business_id, r.ym): r for r in M.mart_business_quality_monthly(f).collect()}
    assert rows[("b1", "2020-01")].avg_rating == 3.0 and rows[("b1", "2020-01")].rating_delta is None
    assert rows[("b1", "2020-04")].rating_delta == 2.0 and rows[("b1", "2020-04")].review_cnt == 1
    assert rows[("b2", "2020-04")].rating_delta is None
    assert sum(r.review_cnt for r in rows.values()) == f.count()


def test_enriched_keeps_reviews_without_business(spark):
    f = fact_rows(spark, [("r1", "b1", 2, "2020-01-05"), ("r2", "missing", 4, "2020-01-06")])
    core = spark.createDataFrame(
        [("b1", "Name", "a", "City", "ST", "1", 1.0, 2.0, 4.5, 10, 1)],
        "business_id string, name string, address string, city string, state string, postal_code string, "
        "latitude double, longitude double, stars double, review_count int, is_open int",
    )
    rows = {r.review_id: r for r in M.mart_review_fact_enriched(f, core).collect()}
    assert len(rows) == 2
    assert rows["r1"].business_name == "Name" and rows["r1"].business_stars == 4.5
    assert rows["r2"].business_name is None and rows["r2"].city is None and rows["r2"].review_stars == 4


def test_city_category_counts_distinct_but_weights_repeats(spark):
    core = spark.createDataFrame([("b1", "C", 5.0), ("b2", "C", 3.0)], "business_id string, city string, stars double")
    cat = spark.createDataFrame([("b1", "Food"), ("b1", "Food"), ("b2", "Food")], "business_id string, category string")
    r = M.mart_city_category_rating(core, cat).collect()[0]
    assert r.business_count == 2
    assert r.avg_rating == pytest.approx((5 + 5 + 3) / 3)


def test_creditcard_share(spark):
    cat = spark.createDataFrame([("b1", "Food"), ("b2", "Food"), ("b3", "Food"), ("b1", "Bars")],
                                "business_id string, category string")
    attrs = spark.createDataFrame(
        [("b1", "BusinessAcceptsCreditCards", "True"), ("b2", "BusinessAcceptsCreditCards", "False"),
         ("b3", "BusinessAcceptsCreditCards", "None"), ("b3", "WiFi", "free")],
        "business_id string, attribute_key string, attribute_value string",
    )
    rows = {r.category: r for r in M.mart_category_creditcard_share(cat, attrs).collect()}
    assert (rows["Food"].businesses_with_info, rows["Food"].accepting_credit_cards) == (2, 1)
    assert rows["Food"].acceptance_level_pct == 50.0
    assert rows["Bars"].acceptance_level_pct == 100.0


def test_rank_within_groups_matches_row_number_on_a_hot_group(spark):
    # one group holds most rows, spread by range partitioning over every task
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise((F.col("id") % 5).cast("string")).alias("g"),
        (F.col("id") * 7919 % 1000).alias("score"),
        F.col("id").cast("string").alias("id"),
    )
    order = [F.col("score").desc(), F.col("id").asc()]
    got = rank_within_groups(df, ["g"], order, "rn", num_partitions=8)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # rn is 1..n within each group
    stats = got.groupBy("g").agg(F.min("rn").alias("lo"), F.max("rn").alias("hi"), F.count("*").alias("n"))
    assert all(r.lo == 1 and r.hi == r.n for r in stats.collect())


def test_top_k_per_group(spark):
    df = spark.createDataFrame([("a", 3), ("a", 2), ("a", 1), ("b", 1)], "g string, v int")
    got = {(r.g, r.v, r.rn) for r in top_k_per_group(df, ["g"], [F.col("v").desc()], 2).collect()}
    assert got == {("a", 3, 1), ("a", 2, 2), ("b", 1, 1)}


def test_sanitize_and_defaults(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, float("-inf")), (4, 1.5), (5, None)],
                               "k int, x double")
    vals = dict((r.k, r.x) for r in sanitize_nan_inf(df).collect())
    assert vals == {1: None, 2: None, 3: None, 4: 1.5, 5: None}
    filled = dict((r.k, r.x) for r in fill_defaults(sanitize_nan_inf(df)).collect())
    assert filled[1] == 0.0 and filled[4] == 1.5


def test_dynamic_partition_overwrite_keeps_other_months(spark):
    path = scratch_path(spark, "t-fact")
    first = fact_rows(spark, [("r1", "b1", 2, "2020-01-05"), ("r2", "b1", 4, "2020-02-06"), ("r9", "b1", 1, None)])
    overwrite_partitions(first, path, "ym", REVIEW_FACT)
    second = fact_rows(spark, [("r3", "b1", 5, "2020-02-10")])
    overwrite_partitions(second, path, "ym", REVIEW_FACT)
    got = {(r.review_id, r.ym) for r in spark.read.schema(REVIEW_FACT).parquet(path).collect()}
    assert got == {("r1", "2020-01"), ("r3", "2020-02"), ("r9", None)}
    # rerunning the same load leaves the same rows
    overwrite_partitions(second, path, "ym", REVIEW_FACT)
    assert spark.read.parquet(path).count() == 3


def test_catalog_layers_and_positional_insert(spark):
    dbs = create_layers(spark, prefix="t")
    fact_tbl = f"{dbs['core']}.review_fact"
    f = fact_rows(spark, [("r1", "b1", 2, "2020-01-05"), ("r2", "b1", 4, "2020-02-06")])
    insert_overwrite_partitions(f.select(*reversed(f.columns)), fact_tbl)  # column order is fixed for the caller
    insert_overwrite_partitions(fact_rows(spark, [("r3", "b1", 5, "2020-02-10")]), fact_tbl)
    assert {r.review_id for r in spark.table(fact_tbl).collect()} == {"r1", "r3"}
    drop_layers(spark, prefix="t")
    assert not spark.catalog.databaseExists(dbs["core"])


def test_publish_partitioned_batches_and_null_key(spark):
    df = spark.createDataFrame(
        [(f"b{i}", "2020-01" if i % 3 else None, float(i), 1, float("nan") if i == 4 else 0.5) for i in range(25)],
        "business_id string, ym string, avg_rating double, review_cnt bigint, rating_delta double",
    )
    path = scratch_path(spark, "t-publish")
    res = publish_partitioned(sanitize_nan_inf(df), path, table="q", partition_col="ym",
                              sort_key=("business_id", "ym"), batch_rows=4)
    assert res.rows_written == 25 and res.rows_read_back == 25
    back = read_published(spark, path, SERVING["mart_business_quality_monthly"].schema)
    assert back.count() == 25 and back.where(F.col("ym").isNull()).count() == 9
    assert back.where(F.col("rating_delta").isNull()).count() == 1
    local = path.removeprefix("file:")
    files = [os.path.join(root, f) for root, _, fs in os.walk(local) for f in fs if f.startswith("part-")]
    counts = [sum(1 for _ in open(f)) for f in files]
    assert len(files) >= 7 and max(counts) <= 4 and sum(counts) == 25
    # rows inside a file follow the serving sort key
    for root, _, fs in os.walk(local):
        for f in fs:
            if f.startswith("part-"):
                ids = [json.loads(line)["business_id"] for line in open(os.path.join(root, f))]
                assert ids == sorted(ids)


def test_publish_rows_append_and_audit(spark):
    df = spark.range(0, 30).select(F.col("id").cast("string").alias("city"))
    path = scratch_path(spark, "t-rows")
    assert publish_rows(df, path, table="t", batch_rows=7).rows_read_back == 30
    assert publish_rows(df, path, table="t", truncate=False).rows_read_back == 30  # an append is audited too
    assert publish_rows(df, path, table="t", truncate=False, audit=False).rows_read_back is None
    assert spark.read.text(path).count() == 90
    # a publish that disagrees with its read-back fails loudly
    with pytest.raises(PublishAuditError):
        from strata.sinks.publish import _audit

        _audit(spark, "t", path, 29, 60)


def test_serving_contract_is_enforced(spark):
    from strata.sinks.publish import for_contract

    contract = SERVING["mart_best_city_avg_rate"]
    df = spark.createDataFrame([("a", 1, None, 2.0)], "city string, business_cnt int, total_reviews bigint, avg_business_rating double")
    assert for_contract(df, contract).schema == contract.schema
    assert for_contract(df, contract.filled()).first()["total_reviews"] == 0
    with pytest.raises(ValueError):
        for_contract(df.drop("city"), contract)
    with pytest.raises(Exception, match="negative"):
        for_contract(df.withColumn("business_cnt", F.lit(-1)), contract).collect()


def test_incremental_merge_idempotent(spark):
    fact_path = scratch_path(spark, "t-inc-fact")
    inc_dir = scratch_path(spark, "t-inc")
    ckpt = scratch_path(spark, "t-inc-ckpt")
    overwrite_partitions(fact_rows(spark, [("r1", "b1", 2, "2020-01-05"), ("r2", "b1", 4, "2020-02-06")]),
                         fact_path, "ym", REVIEW_FACT)
    raw = spark.createDataFrame([("r2", "u", "b1", "5.0", "2020-02-06 00:00:00"), ("r3", "u", "b2", "1", "2020-03-01")],
                                "review_id string, user_id string, business_id string, stars string, date string")
    write_ndjson(raw, inc_dir)
    got = {r.review_id: r.stars for r in incremental_merge(spark, inc_dir, fact_path, ckpt).collect()}
    assert got == {"r1": 2, "r2": 5, "r3": 1}
    # nothing new: rerun is a no-op
    again = {r.review_id: r.stars for r in incremental_merge(spark, inc_dir, fact_path, ckpt).collect()}
    assert again == got


def test_incremental_merge_multiple_batches_bad_lines_and_null_month(spark, tmp_path):
    fact_path = scratch_path(spark, "t-inc2-fact")
    ckpt = scratch_path(spark, "t-inc2-ckpt")
    overwrite_partitions(fact_rows(spark, [("r1", "b1", 2, "2020-01-05")]), fact_path, "ym", REVIEW_FACT)
    inc = tmp_path / "inc"
    inc.mkdir()
    (inc / "a.json").write_text(
        json.dumps({"review_id": "r1", "business_id": "b1", "stars": 3, "date": "2020-01-05 00:00:00"}) + "\n"
        + "NOT JSON\n"
        + json.dumps({"review_id": "r2", "business_id": "b1", "stars": 4, "date": "bad"}) + "\n")
    (inc / "b.json").write_text(
        json.dumps({"review_id": "r1", "business_id": "b1", "stars": 5, "date": "2020-01-05 00:00:00"}) + "\n"
        + json.dumps({"review_id": "r4", "business_id": "b2", "stars": 1, "date": "2020-02-01 00:00:00"}) + "\n")
    got = incremental_merge(spark, str(inc), fact_path, ckpt, max_files_per_trigger=1)
    rows = {r.review_id: (r.stars, r.ym) for r in got.collect()}
    # files are taken in order: the later file's version of r1 wins; the bad line is quarantined
    assert rows == {"r1": (5, "2020-01"), "r2": (4, None), "r4": (1, "2020-02")}
    bad = spark.read.json(ckpt + "-quarantine").select("reason", "raw_line").collect()
    assert [tuple(x) for x in bad] == [("malformed", "NOT JSON")]


def raw_reviews(spark, rows):
    return spark.createDataFrame(rows, "review_id string, user_id string, business_id string, stars string, date string")


def test_merge_moves_a_review_and_drops_its_empty_month(spark):
    path, bad = scratch_path(spark, "t-move"), scratch_path(spark, "t-move-bad")
    overwrite_partitions(fact_rows(spark, [("r1", "b", 2, "2020-01-05"), ("r2", "b", 3, "2020-01-06"), ("r3", "b", 3, "2020-05-01")]),
                         path, "ym", REVIEW_FACT)
    batch = raw_reviews(spark, [("r1", "u", "b", "4", "2020-02-01 00:00:00"), ("r3", "u", "b", "5", "bad date")])
    for _ in range(2):  # and again: a replay changes nothing
        merge_batch(batch, path, bad)
        got = spark.read.schema(REVIEW_FACT).parquet(path)
        assert {(r.review_id, r.ym, r.stars) for r in got.collect()} == {("r1", "2020-02", 4), ("r2", "2020-01", 3), ("r3", None, 5)}
        assert got.count() == 3


def test_merge_quarantines_reviews_without_id_and_replays(spark):
    path, bad = scratch_path(spark, "t-null"), scratch_path(spark, "t-null-bad")
    batch = raw_reviews(spark, [(None, "u", "b1", "1", "2020-01-01"), (None, "u", "b2", "2", "2020-01-01"), ("r1", "u", "b", "3", "2020-01-01")])
    for _ in range(2):
        merge_batch(batch, path, bad, batch_id=7)
        assert [r.review_id for r in spark.read.schema(REVIEW_FACT).parquet(path).collect()] == ["r1"]
        kept = spark.read.json(bad).collect()
        assert [r.batch for r in kept] == [7, 7] and sorted(json.loads(r.raw_line)["business_id"] for r in kept) == ["b1", "b2"]


def test_newest_file_wins_inside_a_batch(spark, tmp_path):
    inc = tmp_path / "inc-newest"
    inc.mkdir()
    for name, stars, t in (("z.json", 1, 1_600_000_000), ("a.json", 5, 1_700_000_000)):
        (inc / name).write_text(json.dumps({"review_id": "r", "business_id": "b", "stars": stars, "date": "2020-01-01"}) + "\n")
        os.utime(inc / name, (t, t))
    got = incremental_merge(spark, str(inc), scratch_path(spark, "t-newest"), scratch_path(spark, "t-newest-ckpt")).collect()
    assert [(r.review_id, r.stars) for r in got] == [("r", 5)]


def test_only_a_missing_path_means_no_fact(spark, tmp_path):
    from strata.streaming.incremental import PathFact

    assert PathFact(str(tmp_path / "none")).read(spark) is None
    with pytest.raises(Exception):
        PathFact("nosuchfs://x/y").read(spark)


def test_null_month_sorts_first_for_delta(spark):
    f = fact_rows(spark, [("r1", "b1", 2, None), ("r2", "b1", 5, "2020-03-01")])
    rows = {r.ym: r for r in M.mart_business_quality_monthly(f).collect()}
    assert rows[None].rating_delta is None
    assert rows["2020-03"].rating_delta == 3.0


def test_incremental_merge_processing_time_trigger(spark, tmp_path):
    import time

    from strata.streaming.incremental import start_incremental_merge

    fact_path = scratch_path(spark, "t-inc3-fact")
    inc = tmp_path / "inc3"
    inc.mkdir()
    (inc / "a.json").write_text(json.dumps({"review_id": "r1", "business_id": "b", "stars": 3,
                                            "date": "2020-05-01 00:00:00"}) + "\n")
    q = start_incremental_merge(spark, str(inc), fact_path, scratch_path(spark, "t-inc3-ckpt"),
                                processing_time="1 second")
    try:
        q.processAllAvailable()
        (inc / "b.json").write_text(json.dumps({"review_id": "r2", "business_id": "b", "stars": 4,
                                                "date": "2020-06-01 00:00:00"}) + "\n")
        time.sleep(1.5)
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r.review_id: r.ym for r in spark.read.schema(REVIEW_FACT).parquet(fact_path).collect()}
    assert got == {"r1": "2020-05", "r2": "2020-06"}


def test_rank_within_groups_shuffle_fallback(spark, monkeypatch):
    import strata.operators.ranking as R

    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("g"),
        (F.col("id") * 31 % 97).alias("score"), F.col("id"))
    order = [F.col("score").desc(), F.col("id").asc()]
    with_conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in with_conf}
    for k, v in with_conf.items():
        spark.conf.set(k, v)
    try:
        got = R.rank_within_groups(df, ["g"], order, "rn", num_partitions=6)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_incremental_merge_creates_fact_on_first_batch(spark, tmp_path):
    fact_path = scratch_path(spark, "t-inc4-fact")  # does not exist yet
    inc = tmp_path / "inc4"
    inc.mkdir()
    (inc / "a.json").write_text(
        json.dumps({"review_id": "r1", "business_id": "b", "stars": "4.0", "date": "2021-01-02 03:04:05"}) + "\n"
        + json.dumps({"review_id": "r1", "business_id": "b", "stars": "2", "date": "2021-01-02 03:04:05"}) + "\n")
    got = incremental_merge(spark, str(inc), fact_path, scratch_path(spark, "t-inc4-ckpt")).collect()
    # a review repeated inside one file is kept once (the greatest row)
    assert [(r.review_id, r.stars, r.ym) for r in got] == [("r1", 4, "2021-01")]


def test_incremental_merge_into_catalog_table(spark, tmp_path):
    from strata.streaming.incremental import TableFact

    target = TableFact("t_inc.review_fact")  # created by the first batch, with its database
    inc = tmp_path / "inc5"
    inc.mkdir()
    (inc / "a.json").write_text(
        json.dumps({"review_id": "r1", "business_id": "b", "stars": 4, "date": "2022-01-01 00:00:00"}) + "\n"
        + json.dumps({"review_id": "r2", "business_id": "b", "stars": 2, "date": "2022-02-01 00:00:00"}) + "\n")
    ckpt = scratch_path(spark, "t-inc5-ckpt")
    incremental_merge(spark, str(inc), target, ckpt)
    (inc / "b.json").write_text(
        json.dumps({"review_id": "r2", "business_id": "b", "stars": 5, "date": "2022-02-01 00:00:00"}) + "\n")
    got = incremental_merge(spark, str(inc), target, ckpt)  # same checkpoint: only b.json is new
    assert {r.review_id: r.stars for r in got.collect()} == {"r1": 4, "r2": 5}
