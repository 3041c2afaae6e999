"""Registered queries: one per operator group, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables under ``sf_dir`` whole (through
``FixtureSource``) and returns a lazy DataFrame.  Queries that exercise
storage (snapshots, ``.tbl`` text, the stored pipeline) write under a fresh
directory of the session's shared checkpoint root first.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import bronze as B
from strata.operators import dashboards as D
from strata.operators import gold as G
from strata.operators import silver as S
from strata.operators.references import Reference, orphan_counts
from strata.operators.suite import load_suite, suite_report
from strata.plans.catalog import Catalog
from strata.plans.hadoop_files import HadoopFiles
from strata.plans.pipeline import RunContext, Runner, run_pipeline
from strata.plans.snapshots import SnapshotStore
from strata.schemas import SOURCE_REFERENCES, SOURCE_TABLES, STAMP
from strata.session import scratch_dir
from strata.sources import FixtureSource, TblSource, read_tbl, tbl_line, write_tbl

# Fixed values for deterministic results: the run stamps of the reference's
# tests and a fixed "today" after the last order date of the test data.
RUN_TS = "2023-01-01T12:00:00.000000"
RUN_TS_NEXT = "2023-01-02T12:00:00.000000"
AS_OF = "2002-01-01"

# The checks of the stored dimensions and fact that ``suite_violations`` reports.
ORDER_SUITE = os.path.join(os.path.dirname(os.path.abspath(__file__)), "suites", "orders.json")

Query = Callable[[SparkSession, str], DataFrame]


def _src(spark: SparkSession, sf_dir: str, partsupp: str = "four") -> FixtureSource:
    return FixtureSource(spark, sf_dir, partsupp)


def _dim_customer(src: FixtureSource, run_ts: str = RUN_TS) -> DataFrame:
    return S.dim_customer(src.table("customer"), src.table("nation"), src.table("region"), run_ts)


def _dim_part(src: FixtureSource, run_ts: str = RUN_TS) -> DataFrame:
    return S.dim_part(src.table("part"), src.table("partsupp"), src.table("supplier"), src.table("nation"),
                      src.table("region"), run_ts, with_supplier_key=src.partsupp_mode == "lines")


def _fct_orders(src: FixtureSource, run_ts: str = RUN_TS) -> DataFrame:
    return S.fct_orders(src.table("orders"), src.table("lineitem"), run_ts)


def _silver(spark: SparkSession, sf_dir: str, partsupp: str = "four", run_ts: str = RUN_TS):
    src = _src(spark, sf_dir, partsupp)
    return _fct_orders(src, run_ts), _dim_customer(src, run_ts), _dim_part(src, run_ts)


def q_finance_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimum slice: lines x orders, customer geography, daily finance metrics (no part join)."""
    src = _src(spark, sf_dir)
    fo, dc = _fct_orders(src), _dim_customer(src)
    return G.finance_metrics(G.customer_lines(fo, dc), RUN_TS, AS_OF)


def _bronze_query(table: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return B.bronze(_src(spark, sf_dir).table(table), RUN_TS)
    q.__doc__ = f"bronze {table}: the whole source table plus the run stamp"
    return q


def q_dim_customer(spark, sf_dir):
    return _dim_customer(_src(spark, sf_dir))


def q_dim_part(spark, sf_dir):
    return _dim_part(_src(spark, sf_dir))


def q_fct_orders(spark, sf_dir):
    return _fct_orders(_src(spark, sf_dir))


def q_wide_order_details(spark, sf_dir):
    fo, dc, dp = _silver(spark, sf_dir)
    return G.wide_order_details(fo, dc, dp, RUN_TS, "part")


def q_wide_order_details_at_grain(spark, sf_dir):
    src = _src(spark, sf_dir, partsupp="lines")
    return G.wide_order_details_from_sources(src.table("orders"), src.table("lineitem"), _dim_customer(src), _dim_part(src), RUN_TS)


def _lines(spark, sf_dir, via: str):
    src = _src(spark, sf_dir)
    dc, dp = _dim_customer(src), _dim_part(src)
    if via == "wide":
        return G.wide_order_details(_fct_orders(src), dc, dp, RUN_TS, "part")
    if via == "silver":
        return G.mart_lines(_fct_orders(src), dc, dp, "part")
    return G.mart_lines_from_sources(src.table("orders"), src.table("lineitem"), dc, dp, "part")


def q_finance_metrics(spark, sf_dir):
    return G.finance_metrics(_lines(spark, sf_dir, via="source"), RUN_TS, AS_OF)


def q_finance_metrics_via_wide(spark, sf_dir):
    return G.finance_metrics(_lines(spark, sf_dir, via="wide"), RUN_TS, AS_OF)


def q_finance_metrics_via_fact(spark, sf_dir):
    return G.finance_metrics(_lines(spark, sf_dir, via="silver"), RUN_TS, AS_OF)


def q_marketing_metrics(spark, sf_dir):
    return G.marketing_metrics(_lines(spark, sf_dir, via="source"), RUN_TS)


def q_marketing_metrics_via_fact(spark, sf_dir):
    return G.marketing_metrics(_lines(spark, sf_dir, via="silver"), RUN_TS)


def q_marketing_metrics_via_wide(spark, sf_dir):
    return G.marketing_metrics(_lines(spark, sf_dir, via="wide"), RUN_TS)


def q_top_brand_by_month_segment(spark, sf_dir):
    ranked = G.top_brands(_lines(spark, sf_dir, via="source"))
    return ranked.where(F.col("rn") == 1).select("month", "market_segment", "brand", "brand_orders")


def q_marketing_by_region(spark, sf_dir):
    return G.marketing_metrics(_lines(spark, sf_dir, via="source"), RUN_TS,
                               by=("month", "customer_region", "market_segment"))


def _two_snapshots(spark, sf_dir, name: str) -> SnapshotStore:
    """Write table ``name`` under two run stamps in a fresh store."""
    store = SnapshotStore(spark, scratch_dir(spark, "snapshots"))
    build = {"fct_orders": _fct_orders, "dim_customer": _dim_customer, "dim_part": _dim_part}[name]
    src = _src(spark, sf_dir)
    for ts in (RUN_TS, RUN_TS_NEXT):
        store.write_stamp(build(src, ts), "silver", name, ts)
    return store


def q_latest_snapshot(spark, sf_dir):
    """Two snapshots of fct_orders written; the latest is read back (pruned scan)."""
    return _two_snapshots(spark, sf_dir, "fct_orders").read_latest("silver", "fct_orders")


def q_named_partition(spark, sf_dir):
    """Two snapshots of dim_customer written; the first is read back by partition value."""
    store = _two_snapshots(spark, sf_dir, "dim_customer")
    return store.read_partition("silver", "dim_customer", {STAMP: RUN_TS})


def q_finance_dashboard(spark, sf_dir):
    return D.finance_dashboard(q_finance_metrics(spark, sf_dir))


def q_marketing_dashboard(spark, sf_dir):
    return D.marketing_dashboard(q_marketing_metrics(spark, sf_dir))


def _dry_context(spark, sf_dir, **kw) -> RunContext:
    return RunContext(spark=spark, source=_src(spark, sf_dir), store=None, run_ts=RUN_TS, as_of=AS_OF,
                      load_data=False, **kw)


def q_key_violations(spark, sf_dir):
    """Validation report over all 14 tables of a dry run."""
    runner = Runner(_dry_context(spark, sf_dir))
    runner.run_all()
    return runner.key_report()


def q_rule_violations(spark, sf_dir):
    """Column-rule report (rows checked, rows failing) over the tables of a dry run."""
    runner = Runner(_dry_context(spark, sf_dir))
    runner.run_all()
    return runner.rule_report()


def _tbl_round_trip(table: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _src(spark, sf_dir).table(table)
        path = scratch_dir(spark, f"tbl-{table}") + f"/{table}.tbl"
        write_tbl(df, path)
        return read_tbl(spark, path, df.schema)
    q.__doc__ = f"{table} written as .tbl text and loaded back"
    return q


def _broken_tbl(spark, sf_dir) -> TblSource:
    """Order lines as .tbl text of which returned lines have no numeric quantity and lines by rail lack their last fields."""
    df = _src(spark, sf_dir).table("lineitem")
    whole, short = tbl_line(df.columns), tbl_line(df.columns[:-2])
    wrong = tbl_line([c if c != "l_quantity" else "_quantity" for c in df.columns])
    root = scratch_dir(spark, "tbl-rejects")
    (df.withColumn("_quantity", F.concat(F.lit("q"), F.col("l_quantity")))
     .select(F.when(F.col("l_shipmode") == "RAIL", short).when(F.col("l_returnflag") == "R", wrong).otherwise(whole).alias("value"))
     .write.text(f"{root}/lineitem.tbl"))
    return TblSource(spark, root, {"lineitem": df.schema}, max_rejects=1 << 62, reject_dir=f"{root}/rejects")


def q_tbl_load_rejects(spark, sf_dir):
    """A load of text with broken lines: the rows of the lines that fit."""
    return _broken_tbl(spark, sf_dir).table("lineitem")


def q_tbl_rejected_lines(spark, sf_dir):
    """The same load stored: its side table of rejected lines, by reason and line."""
    src = _broken_tbl(spark, sf_dir)
    SnapshotStore(spark, f"{src.directory}/lake").write_stamp(src.table("lineitem"), "bronze", "lineitem", RUN_TS)
    src.settle("lineitem")
    return spark.read.parquet(f"{src.reject_dir}/lineitem").select("line", "reason")


def q_pipeline_finance(spark, sf_dir):
    """Dry run of the run graph down to the finance mart."""
    return Runner(_dry_context(spark, sf_dir)).run("finance_metrics")


def q_pipeline_marketing(spark, sf_dir):
    """Dry run of the run graph down to the marketing mart, marts fed by the wide table."""
    return Runner(_dry_context(spark, sf_dir, mart_input="wide")).run("marketing_metrics")


def q_pipeline_stored(spark, sf_dir):
    """Full stored run (14 snapshots + 2 exports); returns the finance export read back."""
    root = scratch_dir(spark, "pipeline")
    ctx = RunContext(spark=spark, source=_src(spark, sf_dir), store=SnapshotStore(spark, root + "/lake"),
                     run_ts=RUN_TS, as_of=AS_OF, load_data=True)
    run_pipeline(ctx, finance_export=root + "/interface/finance", marketing_export=root + "/interface/marketing")
    return spark.read.parquet(root + "/interface/finance")


def q_snapshot_rerun(spark, sf_dir):
    """A stamp written, run again with the lines of finished orders alone, and read back."""
    store = SnapshotStore(spark, scratch_dir(spark, "rerun"))
    df = _fct_orders(_src(spark, sf_dir))
    for rows in (df, df.where("order_status = 'F'")):
        store.write_stamp(rows, "silver", "fct_orders", RUN_TS)
    return store.read_latest("silver", "fct_orders")


def q_snapshot_failed_writes(spark, sf_dir):
    """A snapshot, then a rerun of its stamp and a later stamp that both break inside the write; the first one is read back.

    A row at the end of the fact's value range raises an error, so some tasks
    have written their files when the job fails.  The fact is built once; as in
    a stored run, the later writes take its rows from the stored snapshot.
    """
    store = SnapshotStore(spark, scratch_dir(spark, "failed-writes"))
    good = store.staged(store.write_stamp(_fct_orders(_src(spark, sf_dir)), "silver", "fct_orders", RUN_TS))
    broken = good.withColumn("line_status", F.when(F.col("order_status") == "P", F.raise_error(F.lit("broken row"))).otherwise(F.col("line_status")))
    for stamp in (RUN_TS, RUN_TS_NEXT):
        try:
            store.write_stamp(broken, "silver", "fct_orders", stamp)
        except PySparkException as e:
            if "broken row" not in str(e):
                raise
        else:
            raise AssertionError("the broken write went through")
    store.stage(good, "silver", "fct_orders", RUN_TS_NEXT)  # written in full, never published
    return store.read_latest("silver", "fct_orders")


def q_suite_violations(spark, sf_dir):
    """The order suite's checks over the stored dimensions and fact: rows checked, failed and allowed of each."""
    store, (fct, customers, parts) = SnapshotStore(spark, scratch_dir(spark, "suite")), _silver(spark, sf_dir)
    tables = {name: store.staged(store.stage(df, "silver", name, RUN_TS)) for name, df in (("dim_customer", customers), ("dim_part", parts), ("fct_orders", fct))}
    reports = [suite_report(name, tables[name], checks, tables.__getitem__) for name, checks in load_suite(ORDER_SUITE).items()]
    return reduce(DataFrame.unionByName, reports)


def q_orphan_keys(spark, sf_dir):
    """Rows of the source tables that refer to no parent, for every declared foreign key."""
    src = _src(spark, sf_dir)
    reports = []
    for table, declared in SOURCE_REFERENCES.items():
        references = [Reference(*r) for r in declared]
        reports.append(orphan_counts(table, src.table(table), references, [src.table(r.parent) for r in references]))
    return reduce(DataFrame.unionByName, reports)


def q_pipeline_resumed(spark, sf_dir):
    """A stored run that stops after the wide table, then resumed; the finance export of the resumed run is read back."""
    root = scratch_dir(spark, "resumed")
    Runner(_stored(spark, sf_dir, root)).run("wide_order_details")
    run_pipeline(_stored(spark, sf_dir, root, resume=True), finance_export=root + "/finance")
    return spark.read.parquet(root + "/finance")


def q_latest_wider_snapshot(spark, sf_dir):
    """A second snapshot with one more column (the supplier key); the latest has it."""
    store = SnapshotStore(spark, scratch_dir(spark, "wider"))
    store.write_stamp(_dim_part(_src(spark, sf_dir)), "silver", "dim_part", RUN_TS)
    store.write_stamp(_dim_part(_src(spark, sf_dir, "lines"), RUN_TS_NEXT), "silver", "dim_part", RUN_TS_NEXT)
    return store.read_latest("silver", "dim_part")


def _stored(spark, sf_dir, root: str, **kw) -> RunContext:
    return RunContext(spark=spark, source=_src(spark, sf_dir), store=SnapshotStore(spark, root + "/lake"), run_ts=RUN_TS, as_of=AS_OF, **kw)


def q_pipeline_from_snapshots(spark, sf_dir):
    """A stored run, then the marts alone at the next stamp, from the stored tables; the finance export is read back."""
    root = scratch_dir(spark, "from-snapshots")
    run_pipeline(_stored(spark, sf_dir, root))
    ctx = _stored(spark, sf_dir, root, run_upstream=False)
    ctx.run_ts = RUN_TS_NEXT
    ctx.source = None
    run_pipeline(ctx, finance_export=root + "/finance")
    return spark.read.parquet(root + "/finance")


def q_marketing_export(spark, sf_dir):
    """The marketing mart exported and read back."""
    path = scratch_dir(spark, "marketing") + "/export"
    D.publish(q_marketing_metrics(spark, sf_dir), D.MARKETING_LABELS, D.MARKETING_VIEW, path)
    return spark.read.parquet(path)


def q_finance_dashboard_view(spark, sf_dir):
    """The registered view, read by its name."""
    D.publish(q_finance_metrics(spark, sf_dir), D.FINANCE_LABELS, D.FINANCE_VIEW)
    return spark.table(D.FINANCE_VIEW)


def _catalog(spark, root: str) -> Catalog:
    return Catalog(spark, f"strata_{uuid.uuid4().hex[:12]}", root + "/database")


def q_marketing_view_by_name(spark, sf_dir):
    """The marketing mart stored at two stamps, its dashboard published in the catalog, and read by its name in another session."""
    root = scratch_dir(spark, "catalog")
    store, catalog = SnapshotStore(spark, root + "/lake"), _catalog(spark, root)
    mart = q_marketing_metrics(spark, sf_dir)
    for stamp, rows in ((RUN_TS, mart.limit(0)), (RUN_TS_NEXT, mart)):
        catalog.publish_snapshot(store, store.write_stamp(rows, "gold", "marketing_metrics", stamp))
        name = catalog.publish_view(D.MARKETING_VIEW, "marketing_metrics", D.MARKETING_LABELS)
    return spark.newSession().table(name)


# Buckets of the co-partitioned tables: as many as bring a bucket of lines to so many bytes of their files (some hundred
# MB when a task sorts it), eight at least and at most as many as Spark allows.
BUCKETS, MOST_BUCKETS, BUCKET_BYTES = 8, 100_000, 8 << 20


def bucket_count(file_bytes: int) -> int:
    return min(MOST_BUCKETS, max(BUCKETS, -(-file_bytes // BUCKET_BYTES)))


def _bucketed_sources(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    root, src = scratch_dir(spark, "buckets"), _src(spark, sf_dir)
    catalog, buckets = _catalog(spark, root), bucket_count(HadoopFiles(spark).size(f"{src.sf_dir}/lineitem.parquet"))
    return (catalog.write_bucketed(src.table("orders"), "orders", ["o_orderkey"], buckets, root + "/orders"),
            catalog.write_bucketed(src.table("lineitem"), "lineitem", ["l_orderkey"], buckets, root + "/lineitem"))


def q_fct_orders_bucketed(spark, sf_dir):
    """The fact from orders and lines that are stored dealt by the order key: a join without a shuffle."""
    return S.fct_orders(*_bucketed_sources(spark, sf_dir), RUN_TS)


def q_wide_order_details_misses(spark, sf_dir):
    """The grain join over offers that cover few of the sold (part, supplier) pairs: most lines stay without a part."""
    src = _src(spark, sf_dir)
    dp = S.dim_part(src.table("part"), src.table("partsupp"), src.table("supplier"), src.table("nation"), src.table("region"), RUN_TS,
                    with_supplier_key=True)
    return G.wide_order_details_from_sources(src.table("orders"), src.table("lineitem"), _dim_customer(src), dp, RUN_TS)


QUERIES: dict[str, Query] = {
    "finance_core": q_finance_core,
    **{f"bronze_{t}": _bronze_query(t) for t in SOURCE_TABLES},
    "dim_customer": q_dim_customer,
    "dim_part": q_dim_part,
    "fct_orders": q_fct_orders,
    "wide_order_details": q_wide_order_details,
    "wide_order_details_at_grain": q_wide_order_details_at_grain,
    "finance_metrics": q_finance_metrics,
    "finance_metrics_via_fact": q_finance_metrics_via_fact,
    "finance_metrics_via_wide": q_finance_metrics_via_wide,
    "marketing_metrics": q_marketing_metrics,
    "marketing_metrics_via_fact": q_marketing_metrics_via_fact,
    "marketing_metrics_via_wide": q_marketing_metrics_via_wide,
    "top_brand_by_month_segment": q_top_brand_by_month_segment,
    "marketing_by_region": q_marketing_by_region,
    "latest_snapshot": q_latest_snapshot,
    "named_partition": q_named_partition,
    "finance_dashboard": q_finance_dashboard,
    "marketing_dashboard": q_marketing_dashboard,
    "key_violations": q_key_violations,
    "rule_violations": q_rule_violations,
    "tbl_load_nation": _tbl_round_trip("nation"),
    "tbl_load_lineitem": _tbl_round_trip("lineitem"),
    "tbl_load_rejects": q_tbl_load_rejects,
    "tbl_rejected_lines": q_tbl_rejected_lines,
    "pipeline_finance": q_pipeline_finance,
    "pipeline_marketing": q_pipeline_marketing,
    "pipeline_stored": q_pipeline_stored,
    "snapshot_rerun": q_snapshot_rerun,
    "snapshot_failed_writes": q_snapshot_failed_writes,
    "suite_violations": q_suite_violations,
    "orphan_keys": q_orphan_keys,
    "pipeline_resumed": q_pipeline_resumed,
    "latest_wider_snapshot": q_latest_wider_snapshot,
    "pipeline_from_snapshots": q_pipeline_from_snapshots,
    "marketing_export": q_marketing_export,
    "finance_dashboard_view": q_finance_dashboard_view,
    "marketing_view_by_name": q_marketing_view_by_name,
    "fct_orders_bucketed": q_fct_orders_bucketed,
    "wide_order_details_misses": q_wide_order_details_misses,
}
