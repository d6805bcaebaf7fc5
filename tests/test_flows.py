"""End-to-end job steps on NDJSON written from the sf0.001 feeds."""

from __future__ import annotations

from strata.jobs import main
from strata.plans import core as C
from strata.plans import flows
from strata.plans.registry import QUERIES
from strata.schemas import LAYERS
from strata.session import scratch_path
from strata.sinks.tables import drop_layers
from strata.sinks.writers import write_ndjson
from strata.sources import feeds

SF = "/root/testdata/sf0.001"

MART_QUERY = {
    "mart_city_category_rating": "mart_city_category_rating",
    "mart_best_city_avg_rate": "mart_best_city_avg_rate",
    "mart_top_businesses_per_category": "mart_top_businesses_per_category",
    "mart_category_creditcard_share": "mart_category_creditcard_share",
    "mart_business_quality_monthly": "mart_business_quality_monthly",
    "mart_review_fact_enriched": "mart_review_fact_enriched",
}


def same_rows(a, b) -> bool:
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_all_steps_in_dependency_order(spark):
    root = scratch_path(spark, "lake")
    src_b, src_r = scratch_path(spark, "raw-business"), scratch_path(spark, "raw-review")
    write_ndjson(feeds.entity_feed(spark, SF), src_b)
    write_ndjson(feeds.review_feed(spark, SF), src_r)
    layout = flows.Layout(root)

    flows.ingest_business(spark, src_b, layout)
    flows.ingest_reviews(spark, src_r, layout)
    assert layout.read(spark, "landing", "business_raw").count() == feeds.entity_feed(spark, SF).count()
    assert layout.read(spark, "landing", "review_raw").schema == LAYERS["landing"]["review_raw"]
    flows.split_business(spark, layout)
    flows.write_review_fact(spark, layout)
    for m in flows.MARTS:
        flows.build_mart(spark, m, layout)

    for m, q in MART_QUERY.items():
        written = layout.read(spark, "mart", m)
        assert {f.name: f.dataType for f in written.schema} == {f.name: f.dataType for f in LAYERS["mart"][m]}, m
        assert same_rows(written, QUERIES[q](spark, SF).select(*written.columns)), m

    names = flows.register_tables(spark, layout, prefix="lake")
    assert "lake_core.review_fact" in names and "lake_mart.mart_review_fact_enriched" in names
    n_fact = spark.sql("SELECT count(*) AS n FROM lake_core.review_fact").first().n
    assert n_fact == feeds.review_feed(spark, SF).count()
    assert spark.sql("SELECT count(*) AS n FROM lake_core.review_fact WHERE ym = '1997-03'").first().n == (
        layout.read(spark, "core", "review_fact").where("ym = '1997-03'").count())
    assert spark.sql("SELECT count(*) AS n FROM lake_landing.business_raw").first().n == (
        feeds.entity_feed(spark, SF).count())

    pub = scratch_path(spark, "publish")
    for m in flows.MARTS:
        n = flows.publish_mart(spark, m, layout, pub, dry_run=True)
        res = flows.publish_mart(spark, m, layout, pub, batch_rows=500)
        assert res.rows_written == res.rows_read_back == n, m


def test_cli_dry_run_builds_without_writing(spark, capsys):
    root = scratch_path(spark, "lake-cli")
    src_b = scratch_path(spark, "raw-business")
    write_ndjson(feeds.entity_feed(spark, SF), src_b)
    assert main(["business-landing", "--root", root, "--src", src_b], stop_session=False) == 0
    assert main(["business-split", "--root", root], stop_session=False) == 0
    assert main(["mart", "--root", root, "--name", "mart_best_city_avg_rate", "--dry-run"], stop_session=False) == 0
    assert "Physical Plan" in capsys.readouterr().out


def test_cli_requires_step_arguments():
    import pytest

    with pytest.raises(SystemExit):
        main(["review-increment", "--root", "/tmp/x", "--src", "/tmp/y"], stop_session=False)
    with pytest.raises(SystemExit):
        main(["publish", "--root", "/tmp/x", "--name", "mart_best_city_avg_rate"], stop_session=False)


def test_cli_full_sequence(spark):
    root = scratch_path(spark, "lake-cli2")
    src_b, src_r = scratch_path(spark, "raw-business"), scratch_path(spark, "raw-review")
    write_ndjson(feeds.entity_feed(spark, SF), src_b)
    write_ndjson(feeds.review_feed(spark, SF), src_r)
    pub = scratch_path(spark, "publish-cli")
    steps = [
        ["business-landing", "--root", root, "--src", src_b],
        ["review-landing", "--root", root, "--src", src_r],
        ["business-split", "--root", root],
        ["review-fact", "--root", root],
        ["all-marts", "--root", root],
        ["publish", "--root", root, "--name", "mart_business_quality_monthly", "--publish-root", pub, "--dry-run"],
        ["publish", "--root", root, "--name", "mart_business_quality_monthly", "--publish-root", pub,
         "--batch-rows", "1000"],
        ["publish", "--root", root, "--name", "mart_city_category_rating", "--publish-root", pub, "--fill-defaults"],
        ["publish", "--root", root, "--name", "mart_best_city_avg_rate", "--publish-root", pub, "--no-audit"],
    ]
    for argv in steps:
        assert main(argv, stop_session=False) == 0, argv
    layout = flows.Layout(root)
    n = layout.read(spark, "mart", "mart_business_quality_monthly").count()
    assert spark.read.text(pub + "/mart_business_quality_monthly").count() == n
    # an increment folder merged through the CLI keeps every review exactly once
    inc = scratch_path(spark, "inc-cli")
    write_ndjson(feeds.review_feed(spark, SF).limit(0), inc)
    assert main(["review-increment", "--root", root, "--src", inc, "--stream-checkpoint",
                 scratch_path(spark, "stream")], stop_session=False) == 0
    fact = layout.read(spark, "core", "review_fact")
    assert fact.count() == fact.select("review_id").distinct().count() == feeds.review_feed(spark, SF).count()


def test_catalog_layout_runs_all_steps(spark):
    root = scratch_path(spark, "landing-cat")
    src_b, src_r = scratch_path(spark, "raw-business"), scratch_path(spark, "raw-review")
    write_ndjson(feeds.entity_feed(spark, SF), src_b)
    write_ndjson(feeds.review_feed(spark, SF), src_r)
    for argv in (["business-landing", "--src", src_b], ["review-landing", "--src", src_r], ["business-split"],
                 ["review-fact"], ["all-marts"]):
        assert main(argv + ["--root", root, "--catalog", "cat"], stop_session=False) == 0, argv
    layout = flows.CatalogLayout(root, "cat")
    assert spark.catalog.tableExists("cat_core.review_fact") and spark.catalog.tableExists("cat_mart.mart_best_city_avg_rate")
    for m, q in MART_QUERY.items():
        written = spark.table(f"cat_mart.{m}")
        assert {f.name: f.dataType for f in written.schema} == {f.name: f.dataType for f in LAYERS["mart"][m]}, m
        assert same_rows(written, QUERIES[q](spark, SF).select(*written.columns)), m
    # reloading one month (a corrected extract) replaces only that month
    fact = spark.table("cat_core.review_fact")
    n, n_month = fact.count(), fact.where("ym = '1997-03'").count()
    one = C.review_fact(layout.read(spark, "landing", "review_raw")).where("ym = '1997-03' AND stars >= 3")
    n_one = one.count()
    layout.fact_target().replace_months(one)
    after = spark.table("cat_core.review_fact")
    assert after.count() == n - n_month + n_one
    assert after.where("ym = '1997-03'").count() == n_one


def test_catalog_outlives_its_tables_being_forgotten(spark):
    """What a new process with an empty catalog does: the tables are declared again over the data."""
    root = scratch_path(spark, "lake-forget")
    src_b, src_r = scratch_path(spark, "raw-business"), scratch_path(spark, "raw-review")
    write_ndjson(feeds.entity_feed(spark, SF), src_b)
    write_ndjson(feeds.review_feed(spark, SF), src_r)

    def step(*argv):
        drop_layers(spark, "forget")  # external tables: the data stays
        assert main([*argv, "--root", root, "--catalog", "forget"], stop_session=False) == 0, argv

    step("review-landing", "--src", src_r)
    step("review-fact")  # without a business step before it
    step("business-landing", "--src", src_b)
    step("business-split")
    step("business-split")
    step("mart", "--name", "mart_best_city_avg_rate")
    step("mart", "--name", "mart_review_fact_enriched")
    step("mart", "--name", "mart_review_fact_enriched", "--ym-from", "1997-01", "--ym-to", "1997-03")
    drop_layers(spark, "forget")
    assert len(flows.CatalogLayout(root, "forget").attach(spark)) == 9
    n = feeds.review_feed(spark, SF).count()
    assert spark.table("forget_mart.mart_review_fact_enriched").count() == n
    assert spark.table("forget_landing.review_raw").count() == n
    drop_layers(spark, "forget")


def test_new_process_finds_the_catalog(tmp_path):
    """The same with processes: each step in a session of its own."""
    import os
    import subprocess
    import sys

    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.json").write_text('{"business_id":"b1","name":"n","city":"c","stars":4.0,"categories":"x, y"}\n')
    env = os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}

    def step(*argv):
        done = subprocess.run(
            [sys.executable, "-m", "strata.jobs", *argv, "--root", str(tmp_path / "lake"), "--catalog", "proc", "--conf",
             "spark.ui.enabled=false", "--conf", f"spark.sql.warehouse.dir={tmp_path}/wh", "--conf", "spark.master=local[2]"],
            env=env, cwd=tmp_path, capture_output=True, text=True, timeout=240,
        )
        assert done.returncode == 0, done.stderr[-2000:]

    step("business-landing", "--src", str(raw))
    step("business-split")
    step("mart", "--name", "mart_city_category_rating")


def test_create_and_drop_layers_from_the_command_line(spark, capsys):
    root = scratch_path(spark, "lake-ddl")
    assert main(["create-layers", "--root", root, "--database-prefix", "ddl"], stop_session=False) == 0
    assert "ddl_landing" in capsys.readouterr().out
    kind = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED ddl_landing.review_raw").collect()}
    assert kind["Type"] == "EXTERNAL" and spark.catalog.tableExists("ddl_core.review_fact")
    assert main(["drop-layers", "--root", root, "--database-prefix", "ddl"], stop_session=False) == 0
    assert not spark.catalog.databaseExists("ddl_core")


def test_dry_runs_write_nothing(spark):
    from strata.session import ensure_checkpoint_dir

    root = scratch_path(spark, "lake-dry")
    src_b, src_r = scratch_path(spark, "raw-business"), scratch_path(spark, "raw-review")
    write_ndjson(feeds.entity_feed(spark, SF), src_b)
    write_ndjson(feeds.review_feed(spark, SF), src_r)
    layout = flows.Layout(root)
    flows.ingest_business(spark, src_b, layout)
    flows.ingest_reviews(spark, src_r, layout)
    flows.split_business(spark, layout)
    flows.write_review_fact(spark, layout)

    def files():
        import os

        base = ensure_checkpoint_dir(spark).removeprefix("file:")
        return sorted(os.path.join(d, f) for d, _, fs in os.walk(base) for f in fs)

    before = files()
    for m in flows.MARTS:
        flows.build_mart(spark, m, layout, dry_run=True).explain()
    assert files() == before
    flows.build_mart(spark, "mart_top_businesses_per_category", layout)
    assert not [f for f in files() if "rank-tagged" in f and f not in before]  # scratch is gone after the commit


def test_src_and_dst_tables(spark):
    root, other = scratch_path(spark, "lake-src"), scratch_path(spark, "other")
    src_b = scratch_path(spark, "raw-business")
    write_ndjson(feeds.entity_feed(spark, SF), src_b)
    layout = flows.Layout(root)
    flows.ingest_business(spark, src_b, layout)
    flows.split_business(spark, layout)
    layout.read(spark, "core", "business_core").where("is_open = 1").write.parquet(other)
    dst = scratch_path(spark, "dst")
    argv = ["mart", "--root", root, "--name", "mart_best_city_avg_rate", "--src-table", other, "--dst-table", dst]
    assert main(argv, stop_session=False) == 0
    got = spark.read.parquet(dst).agg({"business_cnt": "sum"}).first()[0]
    assert got == layout.read(spark, "core", "business_core").where("is_open = 1").count()


def test_months_are_refreshed_from_a_pruned_scan(spark):
    layout = flows.Layout(scratch_path(spark, "lake-months"))
    layout.fact_target().replace_months(QUERIES["review_fact"](spark, SF))
    df = flows.read_month_slice(spark, layout.read(spark, "core", "review_fact"), "1997-01", "1997-02")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan
    import pytest

    with pytest.raises(ValueError):
        flows.build_mart(spark, "mart_best_city_avg_rate", layout, ym_from="1997-01")


def test_empty_feed_lands(spark, tmp_path):
    (tmp_path / "empty.json").write_text("")
    layout = flows.Layout(scratch_path(spark, "lake-empty"))
    assert flows.ingest_reviews(spark, str(tmp_path), layout).count() == 0
    assert flows.ingest_business(spark, str(tmp_path), layout).count() == 0
