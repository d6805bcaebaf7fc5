"""Command-line entry: ``python -m strata.jobs <step> [options]``.

Steps: business-landing, review-landing, business-split, review-fact,
review-increment, mart (``--name``), publish (``--name``), all-marts,
register-tables (catalog tables over the layout for SQL access),
create-layers and drop-layers (the declared databases and tables),
business-changes (changed businesses and the city marts that follow from
them), landing-compact (``--kind``: small landed files become larger ones).
Run them in the dependency order given in ``strata.plans.flows``.
"""

from __future__ import annotations

import argparse
import logging
import sys

from strata.plans import flows
from strata.plans.landing import compact_landing
from strata.session import PROFILES, build_session
from strata.sinks.tables import create_layers, drop_layers


def _non_empty(value: str) -> str:
    if not value or not value.strip():
        raise argparse.ArgumentTypeError("must be non-empty")
    return value


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strata.jobs", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("step", choices=["business-landing", "review-landing", "business-split", "review-fact",
                                    "review-increment", "mart", "all-marts", "publish", "register-tables",
                                    "create-layers", "drop-layers", "business-changes", "landing-compact"])
    p.add_argument("--root", type=_non_empty, required=True,
                   help="lakehouse root folder (any Hadoop-FS path)")
    p.add_argument("--catalog", metavar="PREFIX", default=None,
                   help="declare the tables under --root in databases PREFIX_landing / _core / _mart and work on those")
    p.add_argument("--src", type=_non_empty, help="raw NDJSON folder or glob (landing / increment steps)")
    p.add_argument("--name", choices=flows.MARTS, help="mart to build or publish")
    p.add_argument("--publish-root", help="folder receiving published NDJSON batches")
    p.add_argument("--rebalance", action="store_true",
                   help="landing: even out file sizes with one shuffle (for non-splittable input, e.g. gzip)")
    p.add_argument("--batch-rows", type=int, default=None,
                   help="publish: at most so many rows a file (default: files sized by bytes)")
    p.add_argument("--src-table", type=_non_empty, help="a table or path read instead of the step's own input")
    p.add_argument("--dst-table", type=_non_empty, help="mart, review-fact: a table or path written instead of the layout's; publish: its folder under --publish-root")
    p.add_argument("--ym-from", help="mart: refresh the months from this one (yyyy-MM) of a month-partitioned mart")
    p.add_argument("--ym-to", help="mart: up to this month")
    p.add_argument("--max-files-per-trigger", type=int, default=None,
                   help="review-increment: merge a backlog in batches of so many files")
    p.add_argument("--no-truncate", action="store_true", help="append to an existing publish")
    p.add_argument("--fill-defaults", action="store_true", help="publish NULLs as type defaults (0, 0.0, '')")
    p.add_argument("--no-audit", action="store_true",
                   help="skip the read-back row count after a publish (it re-reads the whole output)")
    p.add_argument("--manifest", action="store_true", help="publish: keep the rows of each key beside the files and audit key by key")
    p.add_argument("--ranges", action="store_true", help="publish: files of one key do not overlap in sort order")
    p.add_argument("--statistics", action="store_true", help="with --catalog: store statistics of each written table for the cost-based joins")
    p.add_argument("--kind", choices=["business", "review"], help="landing-compact: which landing dataset")
    p.add_argument("--target-mb", type=int, default=128, help="landing-compact: size of the files")
    p.add_argument("--stream-checkpoint", help="checkpoint folder of the increment stream")
    p.add_argument("--every", default=None, metavar="INTERVAL",
                   help="review-increment: keep running, merging new files at this interval (e.g. '5 minutes')")
    p.add_argument("--database-prefix", default="strata", help="register-tables: databases {prefix}_{layer}")
    p.add_argument("--app-name", default=None)
    p.add_argument("--profile", choices=sorted(PROFILES), default="mvp")
    p.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE", help="extra Spark setting")
    p.add_argument("--dry-run", action="store_true", help="build and explain the plan, write nothing")
    return p


REQUIRED = {
    "business-landing": ["src"],
    "review-landing": ["src"],
    "review-increment": ["src", "stream_checkpoint"],
    "business-changes": ["src"],
    "landing-compact": ["kind"],
    "mart": ["name"],
    "publish": ["name", "publish_root"],
}


def main(argv: list[str] | None = None, stop_session: bool = True) -> int:
    p = parser()
    args = p.parse_args(argv)
    missing = [f"--{a.replace('_', '-')}" for a in REQUIRED.get(args.step, []) if not getattr(args, a)]
    if missing:
        p.error(f"step {args.step} needs {' '.join(missing)}")
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    extra = dict(kv.split("=", 1) for kv in args.conf)
    spark = build_session(args.app_name or f"strata-{args.step}", args.profile, extra)
    layout = flows.CatalogLayout(args.root, args.catalog, args.statistics) if args.catalog else flows.Layout(args.root)
    if args.catalog and args.step not in ("create-layers", "drop-layers"):
        layout.attach(spark)  # the catalog may not outlive a process
    if args.step == "register-tables" and args.catalog:
        p.error("register-tables exposes a path layout; catalog tables are registered already")
    result = None
    if args.step == "business-landing":
        result = flows.ingest_business(spark, args.src, layout, args.dry_run, args.rebalance)
    elif args.step == "review-landing":
        result = flows.ingest_reviews(spark, args.src, layout, args.dry_run, args.rebalance)
    elif args.step == "business-split":
        result = flows.split_business(spark, layout, args.dry_run, args.src_table)
    elif args.step == "review-fact":
        result = flows.write_review_fact(spark, layout, args.dry_run, args.src_table, args.dst_table)
    elif args.step == "review-increment":
        if args.every:
            from strata.streaming.incremental import start_incremental_merge

            start_incremental_merge(spark, args.src, layout.fact_target(), args.stream_checkpoint,
                                    args.max_files_per_trigger, processing_time=args.every).awaitTermination()
        else:
            result = flows.merge_review_increment(spark, args.src, layout, args.stream_checkpoint,
                                                  args.max_files_per_trigger)
    elif args.step == "mart":
        result = flows.build_mart(spark, args.name, layout, args.dry_run, args.ym_from, args.ym_to,
                                  args.src_table, args.dst_table)
    elif args.step == "all-marts":
        result = {m: flows.build_mart(spark, m, layout, args.dry_run) for m in flows.MARTS}
    elif args.step == "register-tables":
        for name in flows.register_tables(spark, layout, args.database_prefix):
            print(name)
    elif args.step == "publish":
        result = flows.publish_mart(spark, args.name, layout, args.publish_root, args.batch_rows,
                                    not args.no_truncate, args.dry_run, args.fill_defaults, not args.no_audit,
                                    args.src_table, args.dst_table, args.manifest, args.ranges)
    elif args.step == "business-changes":
        flows.refresh_businesses(spark, layout, args.src)
    elif args.step == "landing-compact":
        for status in compact_landing(spark, args.kind, layout.path("landing", f"{args.kind}_raw"), args.target_mb << 20):
            print(status)
    elif args.step == "create-layers":
        for db in create_layers(spark, args.catalog or args.database_prefix, landing_root=layout.path("landing", "")).values():
            print(db)
    elif args.step == "drop-layers":
        drop_layers(spark, args.catalog or args.database_prefix)
    if args.dry_run and result is not None:
        frames = result if isinstance(result, dict) else {args.step: result}
        for name, df in frames.items():
            if hasattr(df, "explain"):
                print(f"== {name} ==")
                df.explain("formatted")
    if stop_session:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
