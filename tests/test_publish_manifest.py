"""Publishes with a manifest, and by ranges."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sinks.publish import PublishAuditError, audited_partitions, publish_partitioned, verify_published


def rows(spark, n=400):
    month = F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 10 < 8, "2020-01").otherwise(F.concat(F.lit("2020-0"), (F.col("id") % 3 + 2).cast("string")))
    return spark.range(n).select((F.col("id") * 7919 % n).alias("k"), month.alias("ym"), F.lit("x" * 50).alias("pad"))


def folders(path):
    root = path.removeprefix("file:")
    return {d: [os.path.join(root, d, f) for f in sorted(os.listdir(os.path.join(root, d))) if f.startswith("part-")] for d in os.listdir(root) if d.startswith("ym=")}


def test_manifest_counts_each_key_and_sees_a_row_in_the_wrong_month(spark):
    path = scratch_path(spark, "t-publish")
    df = rows(spark)
    publish_partitioned(df, path, table="t", partition_col="ym", sort_key=("k",), manifest=True)
    want = {r.ym: r["count"] for r in df.groupBy("ym").count().collect()}
    got = {r.partition_value: (r.rows_expected, r.rows_published) for r in audited_partitions(spark, path, "ym").collect()}
    assert got == {k: (n, n) for k, n in want.items()} and None in got
    publish_partitioned(df.limit(50), path, table="t", partition_col="ym", truncate=False, manifest=True)  # an append adds up
    verify_published(spark, path, "ym")
    publish_partitioned(df, path, table="t", partition_col="ym", manifest=True)  # a truncate starts anew
    assert sum(r.rows_expected for r in audited_partitions(spark, path, "ym").collect()) == df.count()
    # one row moves to another month: the total stays, the months do not
    of = folders(path)
    source, target = of["ym=2020-01"][0], of["ym=2020-02"][0]
    lines = open(source).read().splitlines(True)
    open(source, "w").writelines(lines[1:])
    open(target, "a").write(lines[0])
    for f in (source, target):
        os.remove(os.path.join(os.path.dirname(f), "." + os.path.basename(f) + ".crc"))
    assert spark.read.text(path).count() == df.count()
    with pytest.raises(PublishAuditError, match="2020-01.*2020-02"):
        verify_published(spark, path, "ym")


def test_append_to_a_publish_without_manifest_and_missing_manifest(spark):
    path = scratch_path(spark, "t-publish")
    df = rows(spark, 60)
    publish_partitioned(df, path, table="t", partition_col="ym")
    with pytest.raises(PublishAuditError):
        verify_published(spark, path, "ym")
    publish_partitioned(df, path, table="t", partition_col="ym", truncate=False, manifest=True)
    assert {r.rows_expected == r.rows_published for r in audited_partitions(spark, path, "ym").collect()} == {True}
    assert sum(r.rows_expected for r in audited_partitions(spark, path, "ym").collect()) == 120
    empty = scratch_path(spark, "t-publish")
    publish_partitioned(df.limit(0), empty, table="t", partition_col="ym", manifest=True)
    assert audited_partitions(spark, empty, "ym").count() == 0


@pytest.mark.parametrize("ranges", [True, 13])
def test_files_of_a_large_month_do_not_overlap(spark, ranges):
    path = scratch_path(spark, "t-publish")
    df = rows(spark, 5000).repartition(5)
    publish_partitioned(df, path, table="t", partition_col="ym", sort_key=("k",), ranges=ranges, batch_rows=200)
    total = 0
    for of in folders(path).values():
        spans = []
        for f in of:
            keys = [json.loads(x)["k"] for x in open(f)]
            assert keys == sorted(keys) and len({json.loads(x).get("ym") for x in open(f)}) == 1
            spans.append((keys[0], keys[-1]))
            total += len(keys)
        spans.sort()
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert total == 5000 and len(folders(path)["ym=2020-01"]) > 3
