"""Command line: run the pipeline.

    python -m strata --root s3a://bucket/lake --source tbl --source-dir s3a://bucket/tpch
    python -m strata --dry-run --source fixture --source-dir /data/sf0.01 --table finance_metrics

``--root`` (or ``STRATA_ROOT``) is where the layers and the dashboard exports
go: ``{root}/{bronze,silver,gold}/<table>`` and ``{root}/interface/...``.
Sources: ``jdbc`` (settings ``UPS_HOST UPS_PORT UPS_DATABASE UPS_USERNAME
UPS_PASSWORD``), ``tbl`` (dbgen text) or ``parquet``.  Without ``--table``
the full pipeline runs: finance mart and dashboard, then marketing mart and
dashboard, every table once.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys

from strata.operators.suite import load_suite
from strata.plans.pipeline import RunContext, Runner, run_pipeline
from strata.plans.snapshots import SnapshotStore
from strata.session import build_session


def _source(spark, args):
    from strata.sources import FixtureSource, JdbcSource, ParquetSource, TblSource

    if args.source == "jdbc":
        return JdbcSource(spark, num_partitions=args.jdbc_partitions) if args.jdbc_partitions else JdbcSource(spark)
    if not args.source_dir:
        raise SystemExit(f"--source-dir is required for --source {args.source}")
    if args.source == "tbl":
        return TblSource(spark, args.source_dir, max_rejects=args.max_rejects, reject_dir=args.root and f"{args.root.rstrip('/')}/rejects", allow_missing=args.allow_missing)
    return {"parquet": ParquetSource, "fixture": FixtureSource}[args.source](spark, args.source_dir)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="strata", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--root", default=os.environ.get("STRATA_ROOT"))
    ap.add_argument("--source", choices=("jdbc", "tbl", "parquet", "fixture"), default="jdbc")
    ap.add_argument("--source-dir")
    ap.add_argument("--max-rejects", type=int, default=0, help="lines of a .tbl table that may not fit its schema; they go to {root}/rejects/<table>")
    ap.add_argument("--allow-missing", action="store_true", help="a missing .tbl file is an empty table")
    ap.add_argument("--jdbc-partitions", type=int, help="key ranges of a parallel database read (default: by the table's size)")
    ap.add_argument("--keep-going", action="store_true", help="with --table: go on after a table that fails; the exit code says so")
    ap.add_argument("--as-of", help="fixed 'today' for the open-order age (default: current date)")
    ap.add_argument("--run-ts", help="run stamp (default: now, UTC)")
    ap.add_argument("--dry-run", action="store_true", help="build every table without writing")
    ap.add_argument("--from-snapshots", action="store_true", help="read upstream tables from stored snapshots")
    ap.add_argument("--validate", action="store_true", help="check each written table (keys, column rules) before it is published; a failure leaves the earlier snapshot")
    ap.add_argument("--suite", help="JSON file of more checks by table (strata.operators.suite); implies --validate")
    ap.add_argument("--resume", action="store_true", help="go on with the run of --run-ts: tables it has published are read, not built")
    ap.add_argument("--part-match", choices=("part", "part_supplier"), default="part", help="join the fact to offers by part, or at its own grain")
    ap.add_argument("--mart-input", choices=("auto", "wide", "silver", "source"), default="auto",
                    help="marts read the wide table, or the silver or source tables with fan-out weights "
                         "(auto: wide when tables are written, source in a dry run)")
    ap.add_argument("--table", action="append", help="build only these tables (and what they need)")
    ap.add_argument("--master", help="e.g. local[8]; omit under spark-submit")
    ap.add_argument("--cluster-profile", action="store_true",
                    help="apply the large-cluster settings (strata.session.CLUSTER_CONF)")
    args = ap.parse_args(argv)
    if not args.root and not args.dry_run:
        ap.error("--root (or STRATA_ROOT) is required unless --dry-run")
    if args.resume and (args.dry_run or not args.run_ts):
        ap.error("--resume needs --run-ts, and a run that writes")

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    spark = build_session(args.master, cluster=args.cluster_profile, root=args.root)
    ctx = RunContext(
        spark=spark,
        source=_source(spark, args),
        store=SnapshotStore(spark, args.root.rstrip("/")) if args.root else None,
        as_of=args.as_of,
        run_upstream=not args.from_snapshots,
        load_data=not args.dry_run,
        validate=args.validate or bool(args.suite),
        suite=load_suite(args.suite) if args.suite else {},
        resume=args.resume,
        part_match=args.part_match,
        mart_input=args.mart_input,
    )
    if args.run_ts:
        ctx.run_ts = args.run_ts
    failed = 0
    if args.table:
        runner = Runner(ctx)
        built = runner.run_all(args.table, keep_going=args.keep_going)
        failed = len(runner.failed)
    else:
        exports = (None, None) if args.dry_run else (f"{args.root}/interface/finance", f"{args.root}/interface/marketing")
        built = run_pipeline(ctx, *exports)
    if args.dry_run:
        for name, df in built.items():
            df.write.format("noop").mode("overwrite").save()
            logging.info("built %s", name)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
