"""Run graph: each table once, dry run, stored run, snapshots as upstream, validation."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.operators.quality import InvalidDataError, key_report
from strata.plans import tables as T
from strata.plans.pipeline import RunContext, Runner, run_pipeline
from strata.plans.snapshots import SnapshotStore
from strata.queries import AS_OF, RUN_TS, RUN_TS_NEXT
from strata.sources import FixtureSource
from tests.conftest import SF_SMALL
from tests.helpers import spark_table


def _ctx(spark, **kw):
    base = dict(spark=spark, source=FixtureSource(spark, SF_SMALL), run_ts=RUN_TS, as_of=AS_OF)
    base.update(kw)
    return RunContext(**base)


def test_each_table_built_once(spark, monkeypatch):
    calls = []
    specs = T.table_specs("wide")
    for name, spec in list(specs.items()):
        def counted(ctx, up, _b=spec.build, _n=name):
            calls.append(_n)
            return _b(ctx, up)
        specs[name] = T.TableSpec(spec.name, spec.layer, spec.keys, spec.upstream, counted)
    runner = Runner(_ctx(spark, load_data=False, mart_input="wide"), specs)
    runner.run("finance_metrics")
    runner.run("marketing_metrics")
    assert sorted(calls) == sorted(set(calls))
    assert len(calls) == 14


def test_silver_and_wide_mart_inputs_agree(spark):
    a = Runner(_ctx(spark, load_data=False, mart_input="silver")).run("marketing_metrics")
    b = Runner(_ctx(spark, load_data=False, mart_input="wide")).run("marketing_metrics")
    assert spark_table(a) == spark_table(b)


def test_stored_run_then_marts_from_snapshots(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root + "/lake")
    out = run_pipeline(_ctx(spark, store=store, load_data=True),
                       finance_export=tmp_root + "/finance", marketing_export=tmp_root + "/marketing")
    assert len([k for k in out if not k.endswith("_view")]) == 14
    assert spark.table("finance_dashboard_view").columns[0] == "date"
    assert spark.table("marketing_dashboard_view").columns[-1] == "marque_preferee"
    exported = spark.read.parquet(tmp_root + "/finance")
    assert "etl_inserted" in exported.columns and exported.count() == out["finance_metrics"].count()
    # A later run of the gold table alone, from the stored silver snapshots.
    later = Runner(_ctx(spark, store=store, load_data=True, run_upstream=False, run_ts=RUN_TS_NEXT))
    fm = later.run("finance_metrics")
    assert spark_table(fm.drop("etl_inserted")) == spark_table(out["finance_metrics"].drop("etl_inserted"))
    assert store.latest_stamp("gold", "finance_metrics") == RUN_TS_NEXT
    assert store.latest_stamp("silver", "fct_orders") == RUN_TS


def test_validation_blocks_the_write(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root)
    # fct_orders' declared key (order_key, line_number) is not unique in the driver data.
    runner = Runner(_ctx(spark, store=store, load_data=True, validate=True))
    with pytest.raises(InvalidDataError):
        runner.run("fct_orders")
    with pytest.raises(Exception):
        store.read_latest("silver", "fct_orders")


def test_key_report_counts_nulls_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "d"), (None, "e")], "k long, v string")
    r = key_report({"t": (df, ("k",)), "u": (df, ())}).orderBy("table_name").collect()
    assert (r[0].row_count, r[0].null_key_rows, r[0].duplicate_key_values, r[0].duplicate_rows) == (5, 1, 1, 2)
    assert (r[1].row_count, r[1].null_key_rows) == (5, 0)


def test_cycle_is_reported(spark):
    specs = {"a": T.TableSpec("a", "x", (), ("b",), lambda c, u: u["b"]),
             "b": T.TableSpec("b", "x", (), ("a",), lambda c, u: u["a"])}
    with pytest.raises(ValueError, match="cycle"):
        Runner(_ctx(spark, load_data=False), specs).run("a")


def test_command_line_dry_run(spark):
    from strata.__main__ import main

    assert main(["--dry-run", "--source", "fixture", "--source-dir", SF_SMALL, "--as-of", AS_OF,
                 "--table", "dim_customer"]) == 0


def test_pipeline_from_tbl_files_with_a_missing_table(spark, tmp_root):
    """dbgen-style text for 7 tables, no partsupp file: the run completes, parts have no offers."""
    from strata.queries import q_finance_core
    from strata.schemas import SOURCE_SCHEMAS
    from strata.sources import TblSource, write_tbl

    fixture = FixtureSource(spark, SF_SMALL)
    for name, schema in SOURCE_SCHEMAS.items():
        if name == "partsupp":
            continue
        df = fixture.table(name)
        cols = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                for f in schema.fields]
        write_tbl(df.select(*cols), f"{tmp_root}/tbl/{name}.tbl")
    ctx = RunContext(spark=spark, source=TblSource(spark, f"{tmp_root}/tbl", allow_missing=True),
                     store=SnapshotStore(spark, f"{tmp_root}/lake"), run_ts=RUN_TS, as_of=AS_OF)
    out = run_pipeline(ctx)
    assert out["partsupp"].count() == 0
    dp = out["dim_part"]
    assert dp.count() == fixture.table("part").count()
    assert dp.where(F.col("supplier_name").isNotNull()).count() == 0
    # No offers: every line has weight 1, so the mart equals the no-part-join slice.
    assert spark_table(out["finance_metrics"]) == spark_table(q_finance_core(spark, SF_SMALL))


def test_column_rules_count_false_and_null_as_failures(spark):
    from strata.operators.quality import rule_summary, validate

    df = spark.createDataFrame([(1, 0.5), (2, 1.5), (3, None)], "k long, d double")
    rows = {r.rule: r for r in rule_summary("t", df, {"in_range": "d BETWEEN 0 AND 1", "k_set": "k IS NOT NULL"}).collect()}
    assert (rows["in_range"].checked_rows, rows["in_range"].failed_rows) == (3, 2)
    assert rows["k_set"].failed_rows == 0
    with pytest.raises(InvalidDataError, match="in_range"):
        validate("t", df, ("k",), {"in_range": "d BETWEEN 0 AND 1"})
    assert validate("t", df, ("k",), {"k_set": "k IS NOT NULL"})["row_count"] == 3


def test_rows_written_are_counted_by_the_write(spark, tmp_root):
    runner = Runner(_ctx(spark, store=SnapshotStore(spark, tmp_root), load_data=True))
    fct = runner.run("fct_orders")
    assert runner.rows_written["fct_orders"] == fct.count() == FixtureSource(spark, SF_SMALL).table("lineitem").count()
    assert runner.rows_written["orders"] == 1500 and set(runner.rows_written) == {"orders", "lineitem", "fct_orders"}


def _files(store, layer, name):
    return store.files.data_files(store.path(layer, name))


def test_resumed_run_builds_only_what_is_missing(spark, tmp_root):
    store = SnapshotStore(spark, tmp_root)
    Runner(_ctx(spark, store=store)).run("fct_orders")
    done = {t: _files(store, layer, t) for layer, t in (("bronze", "orders"), ("bronze", "lineitem"), ("silver", "fct_orders"))}
    runner = Runner(_ctx(spark, store=store, resume=True))
    runner.run("wide_order_details")
    assert set(runner.resumed) == {"fct_orders"}  # its own upstream tables are not even looked at
    assert {t: _files(store, layer, t) for layer, t in (("bronze", "orders"), ("bronze", "lineitem"), ("silver", "fct_orders"))} == done
    assert set(runner.rows_written) == {"customer", "nation", "region", "part", "partsupp", "supplier", "dim_customer", "dim_part", "wide_order_details"}
    again = Runner(_ctx(spark, store=store, resume=True))
    again.run_all()
    assert "wide_order_details" in again.resumed and set(again.rows_written) == {"finance_metrics", "marketing_metrics"}
    with pytest.raises(ValueError, match="was started with"):
        Runner(_ctx(spark, store=store, resume=True, as_of="1999-01-01"))
    fresh = Runner(_ctx(spark, store=store))  # without resume the stamp is run anew, and an interrupted rerun does not take the first run's tables
    fresh.run("dim_customer")
    later = Runner(_ctx(spark, store=store, resume=True))
    later.run_all(["dim_customer", "dim_part"])
    assert later.resumed == ["dim_customer", "nation", "region"] and "part" in later.rows_written


def test_a_failed_check_leaves_the_earlier_snapshot(spark, tmp_root):
    from strata.operators.suite import parse_suite

    store = SnapshotStore(spark, tmp_root)
    Runner(_ctx(spark, store=store)).run("dim_customer")
    before = _files(store, "silver", "dim_customer")
    suite = parse_suite('{"dim_customer": [{"check": "between", "column": "account_balance", "min": 0}]}')
    for stamp in (RUN_TS, RUN_TS_NEXT):
        runner = Runner(_ctx(spark, store=store, run_ts=stamp, validate=True, suite=suite))
        with pytest.raises(InvalidDataError, match="between.account_balance. failed on"):
            runner.run("dim_customer")
    assert store.stamps("silver", "dim_customer") == [RUN_TS] and _files(store, "silver", "dim_customer") == before
    allowed = parse_suite('{"dim_customer": [{"check": "between", "column": "account_balance", "min": 0, "allow": 1000}]}')
    Runner(_ctx(spark, store=store, run_ts=RUN_TS_NEXT, validate=True, suite=allowed)).run("dim_customer")
    assert store.latest_stamp("silver", "dim_customer") == RUN_TS_NEXT


def test_null_keys_are_found_where_keys_repeat(spark):
    """``dim_part`` repeats its key by design; a NULL in it is still an error."""
    specs = {"dim_part": T.TableSpec("dim_part", "silver", ("part_key",), (), lambda c, u: spark.createDataFrame([(1,), (1,), (None,)], "part_key long"), unique=False)}
    with pytest.raises(InvalidDataError, match="not_null.part_key. failed on 1 of 3 rows"):
        Runner(_ctx(spark, load_data=False, validate=True), specs).run("dim_part")


def test_a_run_goes_on_after_a_table_that_fails(spark, tmp_root):
    from strata.sources import TblSource, write_tbl

    fixture = FixtureSource(spark, SF_SMALL)
    for name in ("region", "nation", "customer", "supplier"):
        df = fixture.table(name)
        schema = TblSource(spark, tmp_root).schemas[name]
        write_tbl(df.select(*[F.col(f.name) if f.name in df.columns and f.name != "s_suppkey" else F.lit("bad" if f.name == "s_suppkey" else None).alias(f.name) for f in schema.fields]), f"{tmp_root}/{name}.tbl")
    runner = Runner(_ctx(spark, source=TblSource(spark, tmp_root), store=SnapshotStore(spark, f"{tmp_root}/lake")))
    built = runner.run_all(["supplier", "part", "dim_part", "dim_customer"], keep_going=True)
    assert set(built) == {"region", "nation", "customer", "dim_customer"} and set(runner.failed) == {"supplier", "part", "dim_part"}
    assert runner.failed["supplier"].startswith("supplier: 10 lines do not fit") and "part.tbl" in runner.failed["part"]
    assert runner.ctx.store.stamps("bronze", "supplier") == []
