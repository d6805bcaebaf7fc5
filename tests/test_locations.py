"""The merge by a location index: what it reads, and that it equals the fact."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from strata.plans import flows
from strata.schemas import REVIEW_FACT
from strata.session import scratch_path
from strata.sinks.tables import overwrite_parquet
from strata.streaming import incremental
from strata.streaming.incremental import PathFact, incremental_merge, merge_batch, months_slice
from strata.streaming.locations import LocationIndex


def review(i, date, stars=3):
    return {"review_id": f"r{i}", "user_id": "u", "business_id": f"b{i % 3}", "stars": str(stars), "date": date}


def dated(i):
    return f"20{10 + i % 5:02d}-{1 + i % 12:02d}-03 10:00:00"


def load(spark, path, ids):
    rows = spark.createDataFrame([{**review(i, dated(i)), "ym": dated(i)[:7]} for i in ids])
    fact = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in REVIEW_FACT.fields])
    overwrite_parquet(fact, path, REVIEW_FACT, partition_by=["ym"])


def batch(spark, rows):
    return spark.read.schema(incremental.REVIEW_RAW_READ).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))


def places(df):
    return sorted(((r.review_id, r.ym) for r in df.collect()), key=str)


def test_index_follows_moves_replays_and_new_reviews(spark):
    path = scratch_path(spark, "t-fact")
    load(spark, path, range(60))
    index = PathFact(path).index()
    bad = scratch_path(spark, "t-bad")
    steps = [
        [review(1, "2030-01-01 00:00:00", 1), review(100, "2011-02-03 00:00:00")],  # a move and a new one
        [review(1, "2030-01-01 00:00:00", 1), review(100, "2011-02-03 00:00:00")],  # the same again
        [review(1, "2012-05-05 00:00:00", 5), review(2, None)],  # moved back, and to no month
        [review(2, "2031-01-01 00:00:00")],
    ]
    for n, rows in enumerate(steps):
        merge_batch(batch(spark, rows), path, bad, n)
        fact = PathFact(path).read(spark)
        assert places(index.locations(spark)) == places(fact)
        assert index.missing(fact).isEmpty() and fact.count() == fact.select("review_id").distinct().count()
    assert {r.ym for r in PathFact(path).read(spark).where("review_id IN ('r1', 'r2')").collect()} == {"2012-05", "2031-01"}
    assert index.versions(spark) == [1, 2, 3, 4, 5]
    index.compact(spark)
    assert index.versions(spark) == [6] and places(index.locations(spark)) == places(PathFact(path).read(spark))


def test_merge_after_a_break_between_index_and_months_loses_no_older_version(spark, monkeypatch):
    path, bad = scratch_path(spark, "t-fact"), scratch_path(spark, "t-bad")
    load(spark, path, range(20))
    rows = [review(4, "2040-01-01 00:00:00")]
    with monkeypatch.context() as m:
        m.setattr(PathFact, "replace_months", lambda self, df: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            merge_batch(batch(spark, rows), path, bad)
    merge_batch(batch(spark, rows), path, bad)  # the stream repeats the batch
    assert [r.ym for r in PathFact(path).read(spark).where("review_id = 'r4'").collect()] == ["2040-01"]
    assert PathFact(path).read(spark).count() == 20


def test_a_batch_reads_only_its_buckets_and_months(spark):
    path = scratch_path(spark, "t-fact")
    load(spark, path, range(60))
    index = PathFact(path).index()
    index.build(PathFact(path).read(spark))
    ids = spark.createDataFrame([("r7",), ("r12",)], "review_id string")
    months = index.months_of(ids)
    plan = months._jdf.queryExecution().executedPlan().toString()
    assert path + "/" not in plan and "PartitionFilters: [bucket" in plan  # the index alone, cut to the buckets
    own = index.read(spark).where(F.col("bucket").isin([r[0] for r in ids.select(index.bucket()).collect()]))
    assert own.select(F.input_file_name()).distinct().count() <= 2 < len(index.read(spark).inputFiles())
    assert sorted(r.ym for r in months.collect()) == sorted({dated(7)[:7], dated(12)[:7]})
    touched = months_slice(PathFact(path).read(spark), months)
    scan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [ym#" in scan and "IN (" in scan.split("PartitionFilters")[1]
    assert {r.ym for r in touched.select("ym").distinct().collect()} == {dated(7)[:7], dated(12)[:7]}


def test_many_months_go_through_a_join(spark, monkeypatch):
    path, bad = scratch_path(spark, "t-fact"), scratch_path(spark, "t-bad")
    load(spark, path, range(40))
    monkeypatch.setattr(incremental, "MOST_LISTED", 1)
    merge_batch(batch(spark, [review(i, f"2050-0{1 + i % 9}-01 00:00:00") for i in range(0, 40, 2)] + [review(1, None)]), path, bad)
    fact = PathFact(path).read(spark)
    assert fact.count() == 40 and places(PathFact(path).index().locations(spark)) == places(fact)
    assert fact.where("ym IS NULL").count() == 1 and fact.where("ym LIKE '2050%'").count() == 20


def test_compaction_when_due_and_reload_of_months(spark, tmp_path):
    layout = flows.Layout(scratch_path(spark, "t-lake"))
    target = layout.fact_target()
    load(spark, target.path, range(30))
    small = LocationIndex(target.index().path, compact_after=1)
    small.build(target.read(spark))
    small.add(target.read(spark).limit(3))
    small.compact_if_due(spark)
    assert len(small.versions(spark)) == 1 and places(small.locations(spark)) == places(target.read(spark))
    src = tmp_path / "more"
    src.mkdir()
    (src / "a.json").write_text("\n".join(json.dumps(review(i, "2022-02-02 00:00:00")) for i in range(200, 204)))
    flows.ingest_reviews(spark, str(src), layout)
    flows.write_review_fact(spark, layout)  # a reload tells the index
    assert target.index().missing(target.read(spark)).isEmpty()
    inc = tmp_path / "inc"
    inc.mkdir()
    (inc / "b.json").write_text(json.dumps(review(201, "2023-03-03 00:00:00")))
    got = incremental_merge(spark, str(inc), target.path, scratch_path(spark, "t-ck"))
    assert [r.ym for r in got.where("review_id = 'r201'").collect()] == ["2023-03"]
