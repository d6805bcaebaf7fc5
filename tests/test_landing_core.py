"""Edge cases of the landing and core layers (hand-written NDJSON lines)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from strata.plans import core as C
from strata.plans.landing import (
    land_ndjson,
    landing_from_ndjson,
    read_landing,
    read_quarantine,
)
from strata.schemas import BUSINESS_LANDING, REVIEW_LANDING


def biz(**kw):
    base = {"business_id": "b1", "name": "N", "city": "C", "stars": 4.5}
    base.update(kw)
    return base


def test_corrupt_line_is_quarantined_and_rest_landed(spark, ndjson, tmp_path):
    src = ndjson([biz(), "BROKEN", biz(business_id="b2")])
    dst = str(tmp_path / "landing")
    land_ndjson(spark, "business", src, dst)
    good = read_landing(spark, "business", dst)
    assert sorted(r.business_id for r in good.collect()) == ["b1", "b2"]
    assert [r.raw_line for r in read_quarantine(spark, dst).collect()] == ["BROKEN"]
    assert good.schema == BUSINESS_LANDING


def test_missing_key_gives_null_column(spark, ndjson):
    df = landing_from_ndjson(spark, "business", ndjson([biz(), biz(business_id="b2")]))
    assert "hours" in df.columns
    assert df.where(F.col("hours").isNotNull()).count() == 0


def test_numeric_postal_code_becomes_text_and_types_conform(spark, ndjson):
    df = landing_from_ndjson(
        spark, "business",
        ndjson([biz(postal_code=94107, review_count=12, is_open=1, latitude=1.5, longitude="x")]),
    )
    r = df.collect()[0]
    assert r.postal_code == "94107"
    assert r.review_count == 12 and r.is_open == 1
    assert r.latitude == 1.5 and r.longitude is None
    assert df.schema == BUSINESS_LANDING


def test_review_count_overflow_becomes_null(spark, ndjson):
    r = landing_from_ndjson(spark, "business", ndjson([biz(review_count=3000000000)])).collect()[0]
    assert r.review_count is None


def test_duplicate_business_keeps_smallest_row(spark, ndjson):
    land = landing_from_ndjson(spark, "business", ndjson([biz(name="zeta"), biz(name="alpha")]))
    rows = C.business_core(land).collect()
    assert len(rows) == 1 and rows[0].name == "alpha"


def test_categories_split_trim_drop_blank_keep_repeat(spark, ndjson):
    land = landing_from_ndjson(spark, "business", ndjson([biz(categories="Food,  Bars, ,Food")]))
    cats = [r.category for r in C.business_category(land).collect()]
    assert sorted(cats) == ["Bars", "Food", "Food"]


def test_attributes_null_dropped_nested_kept(spark, ndjson):
    line = '{"business_id":"b1","attributes":{"A":true,"B":null,"P":{"x":1}}}'
    land = landing_from_ndjson(spark, "business", ndjson([line]))
    assert json.loads(land.collect()[0].attributes) == {"A": "true", "P": '{"x":1}'}
    kv = {(r.attribute_key, r.attribute_value) for r in C.business_attributes(land).collect()}
    assert kv == {("A", "true"), ("P", '{"x":1}')}


def test_attributes_empty_unparsable_null_give_no_rows(spark, ndjson):
    lines = [
        '{"business_id":"b1","attributes":{}}',
        '{"business_id":"b2","attributes":"notjson"}',
        '{"business_id":"b3","attributes":null}',
    ]
    land = landing_from_ndjson(spark, "business", ndjson(lines))
    assert land.count() == 3
    assert C.business_attributes(land).count() == 0


def test_attribute_key_cleanup(spark, ndjson):
    attrs = {"u'Key'": "1", "'Key2'": "2", '"Key3"': "3", 'u"Key4"': "4", 'menu"x': "5"}
    land = landing_from_ndjson(spark, "business", ndjson([{"business_id": "b1", "attributes": attrs}]))
    keys = sorted(r.attribute_key for r in C.business_attributes(land).collect())
    assert keys == ["Key", "Key2", "Key3", "Key4", 'menu"x']


def test_hours_parsing(spark, ndjson):
    hours = {"Monday": "8:0-22:30", "Friday": "22:0-2:0", "Sunday": "closed", "Tuesday": None}
    land = landing_from_ndjson(spark, "business", ndjson([{"business_id": "b1", "hours": hours}]))
    rows = {r.day_of_week: r for r in C.business_hours(land).collect()}
    assert set(rows) == {"Monday", "Friday", "Sunday"}
    m = rows["Monday"]
    assert (m.open_hour, m.open_minute, m.close_hour, m.close_minute, m.open_minutes, m.close_minutes) == (
        8, 0, 22, 30, 480, 1350)
    f = rows["Friday"]
    assert (f.open_minutes, f.close_minutes) == (1320, 120)
    s = rows["Sunday"]
    assert all(v is None for v in (s.open_hour, s.open_minute, s.close_hour, s.close_minute,
                                   s.open_minutes, s.close_minutes))


def test_review_stars_and_dates(spark, ndjson):
    lines = [
        {"review_id": "r1", "business_id": "b1", "stars": 5.0, "date": "2020-01-02 03:04:05"},
        {"review_id": "r2", "business_id": "b1", "stars": "zz", "date": "bad"},
        {"review_id": "r3", "business_id": "b1", "stars": "4", "date": "2020-02-03"},
    ]
    land = landing_from_ndjson(spark, "review", ndjson(lines))
    assert land.schema == REVIEW_LANDING
    fact = {r.review_id: r for r in C.review_fact(land).collect()}
    assert fact["r1"].stars == 5 and fact["r1"].ym == "2020-01"
    assert fact["r2"].stars is None and fact["r2"].review_date is None and fact["r2"].ym is None
    assert fact["r3"].stars == 4 and fact["r3"].ym == "2020-02"
    assert "text" not in C.review_fact(land).columns


def test_conform_bigint_is_exact(spark):
    from strata.operators.conform import conform
    from strata.schemas import struct, L

    df = spark.createDataFrame([("9007199254740993",), ("5.0",), ("x",)], "v string")
    got = [r.v for r in conform(df, struct(("v", L))).collect()]
    assert got == [9007199254740993, 5, None]


def test_landing_file_sizing(spark, ndjson, tmp_path):
    import gzip
    import hashlib
    import os

    # many small files are packed into shared input splits: few output files, no shuffle
    srcs = [ndjson([biz(business_id=f"b{i}{j}") for j in range(5)], name=f"many/f{i}") for i in range(12)]
    parent = os.path.dirname(srcs[0])
    dst = str(tmp_path / "landing-many")
    land_ndjson(spark, "business", parent + "/*", dst)
    files = [f for f in os.listdir(os.path.join(dst, "_landing_status=valid")) if f.startswith("part-")]
    assert read_landing(spark, "business", dst).count() == 60
    assert len(files) < 12
    # one large gzip file is read by one task; rebalancing spreads the write over several
    gz = tmp_path / "gz"
    gz.mkdir()
    with gzip.open(gz / "big.json.gz", "wt") as fh:
        for i in range(20000):
            name = hashlib.sha256(str(i).encode()).hexdigest()  # incompressible, so sizes are real
            fh.write(json.dumps(biz(business_id=f"g{i}", name=name, address=name[::-1])) + "\n")
    out = str(tmp_path / "landing-gz")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        land_ndjson(spark, "business", str(gz), out, rebalance=True)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
    files = [f for f in os.listdir(os.path.join(out, "_landing_status=valid")) if f.startswith("part-")]
    assert read_landing(spark, "business", out).count() == 20000
    assert len(files) > 1


def test_core_keeps_attribute_rows_with_null_value(spark):
    # landing drops NULL-valued keys; a landing produced elsewhere may still carry them
    land = spark.createDataFrame([("b1", '{"A":null,"B":"x"}')], "business_id string, attributes string")
    kv = {(r.attribute_key, r.attribute_value) for r in C.business_attributes(land).collect()}
    assert kv == {("A", None), ("B", "x")}


def test_blank_paths_are_rejected(spark):
    import pytest

    from strata.sources.ndjson import read_ndjson
    from strata.schemas import BUSINESS_RAW_READ

    with pytest.raises(ValueError):
        read_ndjson(spark, "  ", BUSINESS_RAW_READ)
    with pytest.raises(ValueError):
        land_ndjson(spark, "business", "/tmp/does-not-matter", " ")
