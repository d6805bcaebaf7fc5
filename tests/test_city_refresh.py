"""City marts kept by change against a rebuild."""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import functions as F

from strata.plans import flows, refresh
from strata.plans import marts as M
from strata.session import scratch_path


def business(i, r):
    stars = r.choice(["1.0", "2.5", "4.5", "5", None, "junk"])
    cats = r.choice(["a, b", "a, a, c", "", None, "b"])
    return {"business_id": f"b{i}", "name": f"n{i}", "city": r.choice(["X", "Y", "Z", None]), "stars": stars, "review_count": r.choice(["3", "7", None]), "categories": cats}


def write(tmp_path, name, rows):
    d = tmp_path / name
    d.mkdir()
    (d / "a.json").write_text("\n".join(json.dumps({k: v for k, v in x.items() if v is not None}) for x in rows))
    return str(d)


def rows_of(df):
    return sorted((tuple(x) for x in df.collect()), key=str)


def check(spark, layout):
    core, category = layout.read(spark, "core", "business_core"), layout.read(spark, "core", "business_category")
    assert rows_of(layout.read(spark, "mart", "mart_city_category_rating")) == rows_of(M.mart_city_category_rating(core, category))
    assert rows_of(layout.read(spark, "mart", "mart_best_city_avg_rate")) == rows_of(M.mart_best_city_avg_rate(core))
    state = refresh.read_partials(spark, layout)
    again = refresh.partials(core, category)
    for k in state:
        assert rows_of(state[k].select(*again[k].columns).fillna(0)) == rows_of(again[k].fillna(0))
    return core


def test_changes_equal_a_rebuild(spark, tmp_path):
    r = random.Random(1)
    layout = flows.Layout(scratch_path(spark, "t-lake"))
    first = [business(i, r) for i in range(60)] + [business(i, r) for i in range(0, 60, 9)]  # some are listed twice
    flows.ingest_business(spark, write(tmp_path, "first", first), layout)
    flows.split_business(spark, layout)
    assert refresh.read_partials(spark, layout) is None
    flows.refresh_businesses(spark, layout, write(tmp_path, "one", [business(i, r) for i in range(5, 20)] + [business(100, r), {"name": "no id"}]))
    assert check(spark, layout).count() == 61
    gone = spark.createDataFrame([(f"b{i}",) for i in (1, 2, 100, 555)], "business_id string")
    flows.refresh_businesses(spark, layout, write(tmp_path, "two", [business(i, r) for i in range(10, 13)]), removed=gone)
    assert check(spark, layout).count() == 58
    everything = spark.createDataFrame([(f"b{i}",) for i in range(60)], "business_id string")
    flows.refresh_businesses(spark, layout, write(tmp_path, "three", [{"business_id": "only", "city": "Q", "stars": "3", "categories": "z"}]), removed=everything)
    check(spark, layout)
    assert rows_of(layout.read(spark, "mart", "mart_best_city_avg_rate")) == [("Q", 1, None, 3.0)]


def test_ratings_no_decimal_holds_come_and_go(spark):
    core = spark.createDataFrame([("a", "X", 4.0, 1), ("b", "X", float("nan"), 2), ("c", "X", 1e-9, None)], "business_id string, city string, stars double, review_count int")
    category = spark.createDataFrame([("a", "k"), ("b", "k"), ("b", "k")], "business_id string, category string")
    state = refresh.partials(core, category)
    assert all(math.isnan(refresh.mart_of("city", state["city"]).first()["avg_business_rating"]) for _ in "x")
    odd = refresh.partials(core.where("business_id <> 'a'"), category.where("business_id <> 'a'"))
    left = refresh.merged(state["city"], state["city"].limit(0), odd["city"], ["city"])
    assert rows_of(refresh.mart_of("city", left)) == [("X", 1, 1, 4.0)]
    assert refresh.merged(left, left.limit(0), left, ["city"]).count() == 0


def test_only_changed_businesses_are_joined(spark, tmp_path):
    """The partials of a change come from semi-joined rows; the merge itself is a union and one aggregate."""
    core = spark.createDataFrame([("a", "X", 4.0, 1)], "business_id string, city string, stars double, review_count int")
    state = refresh.partials(core, spark.createDataFrame([("a", "k")], "business_id string, category string"))["city_category"]
    path = scratch_path(spark, "t-state")
    state.write.parquet(path)
    stored = spark.read.parquet(path)
    plan = refresh.merged(stored, stored, stored, ["city", "category"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Union" in plan
    assert stored.select(F.sum("businesses")).first()[0] == 1
