"""Check suites and referential checks."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from strata.operators.references import Reference, orphan_counts
from strata.operators.suite import SuiteError, load_suite, parse_suite, suite_report, violations
from strata.plans.snapshots import SnapshotStore
from strata.queries import ORDER_SUITE, QUERIES
from tests.conftest import SF_SMALL

ROWS = [(1, "a", 5.0), (1, "b", 0.5), (2, "c", None), (None, None, 7.0), (None, "zz", 2.0)]


def _counts(report):
    return {r.check_name: (r.checked_rows, r.failed_rows) for r in report.collect()}


def test_every_kind_of_check(spark):
    df = spark.createDataFrame(ROWS, "k long, s string, x double")
    parents = {"p": spark.createDataFrame([(1,), (1,), (3,)], "id int")}
    checks = parse_suite("""{"t": [{"check": "not_null", "column": "k"}, {"check": "unique", "columns": ["k"]}, {"check": "in_set", "column": "s", "values": ["a", "b", "c"]},
        {"check": "between", "column": "x", "min": 1, "max": 6}, {"check": "between", "column": "x", "name": "open"}, {"check": "matches", "column": "s", "pattern": "^.$"},
        {"check": "satisfies", "expression": "x < 6"}, {"check": "row_count", "min": 7}, {"check": "row_count", "max": 3, "name": "most"},
        {"check": "foreign_key", "columns": ["k"], "table": "p", "references": ["id"]}]}""")["t"]
    want = {"not_null(k)": (5, 2), "unique(k)": (5, 1), "in_set(s)": (5, 1), "between(x)": (5, 2), "open": (5, 0), "matches(s)": (5, 1), "satisfies(x < 6)": (5, 2),
            "row_count()": (5, 2), "most": (5, 2), "foreign_key(k) -> p": (5, 1)}
    assert _counts(suite_report("t", df, checks, parents.__getitem__)) == want
    empty = _counts(suite_report("t", df.limit(0), checks, parents.__getitem__))
    assert {k: v for k, v in empty.items() if v != (0, 0)} == {"row_count()": (0, 7)}
    assert suite_report("t", df, ()) is None and violations(None) == []


def test_allowed_rows(spark):
    df = spark.createDataFrame(ROWS, "k long, s string, x double")
    for allow, found in ((1, ["not_null(k) failed on 2 of 5 rows"]), (2, [])):
        assert violations(suite_report("t", df, parse_suite(f'{{"t": [{{"check": "not_null", "column": "k", "allow": {allow}}}]}}')["t"])) == found


@pytest.mark.parametrize(("text", "message"), [
    ("[]", "object of lists"),
    ('{"t": [{"check": "shiny"}]}', "t, check 1: .check. must be one of not_null"),
    ('{"t": [{"check": "not_null", "column": "a"}, {"check": "in_set", "column": "a"}]}', "t, check 2: in_set takes"),
    ('{"t": [{"check": "not_null", "column": "a", "size": 3}]}', "not_null takes"),
    ('{"t": [{"check": "foreign_key", "columns": ["a", "b"], "table": "p", "references": ["a"]}]}', "as many references"),
    ('{"t": [{"check": "not_null", "column": "a"}, {"check": "not_null", "column": "a"}]}', "checks of one name"),
])
def test_suites_that_cannot_be_compiled(text, message):
    with pytest.raises(SuiteError, match=message):
        parse_suite(text)


def test_row_checks_read_the_stored_table_once(spark, tmp_root):
    """All row checks of the fact are one aggregate over one scan of its written files; keys and references scan their own columns only."""
    checks = load_suite(ORDER_SUITE)["fct_orders"]
    store = SnapshotStore(spark, tmp_root)
    out = store.staged(store.stage(QUERIES["fct_orders"](spark, SF_SMALL), "silver", "fct_orders", "2023"))
    by_row = [c for c in checks if c.kind not in ("unique", "foreign_key")]
    plan = suite_report("fct_orders", out, by_row)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and "lineitem.parquet" not in plan
    parents = {n: QUERIES[n](spark, SF_SMALL) for n in ("dim_customer", "dim_part")}
    whole = suite_report("fct_orders", out, checks, parents.__getitem__)._jdf.queryExecution().sparkPlan().toString()
    assert len(re.findall(r"FileScan parquet \[[^]]*order_key", whole)) == 2  # row checks, and the unique key


def test_orphans_against_brute_force(spark):
    parents = {"p": [(i, f"s{i % 7}") for i in range(50)], "q": [(i, i % 3) for i in range(20)]}
    child = [(i % 61 if i % 11 else None, f"s{i % 9}", i % 23, i % 3) for i in range(5000)] + [(7, "s0", 1, 1)] * 2500  # a third of all rows has one key
    df = spark.createDataFrame(child, "a long, b string, c int, d int").repartition(6)
    frames = {"p": spark.createDataFrame(parents["p"], "id int, name string"), "q": spark.createDataFrame(parents["q"], "c long, d long")}
    refs = [Reference(("a",), "p", ("id",)), Reference(("b",), "p", ("name",)), Reference(("c", "d"), "q", ("c", "d"))]
    got = {r.reference: (r.checked_rows, r.orphan_rows, r.orphan_keys) for r in orphan_counts("t", df, refs, [frames[r.parent] for r in refs]).collect()}
    want = {}
    for r, known, key in ((refs[0], {x[0] for x in parents["p"]}, lambda x: (x[0],)), (refs[1], {x[1] for x in parents["p"]}, lambda x: (x[1],)), (refs[2], set(parents["q"]), lambda x: (x[2], x[3]))):
        lost = [key(x) for x in child if None not in key(x) and (key(x) if len(key(x)) > 1 else key(x)[0]) not in known]
        want[r.name] = (len(child), len(lost), len(set(lost)))
    assert got == want
    assert [tuple(r)[2:] for r in orphan_counts("t", df.limit(0), refs[:1], [frames["p"]]).collect()] == [(0, 0, 0)]


def test_references_shuffle_keys_folded_in_each_task(spark):
    """The child's rows are folded before the exchange: nothing but (reference, key, count) travels."""
    child = spark.range(1000).select((F.col("id") % 5).alias("a"), F.lit("x" * 50).alias("wide"))
    plan = orphan_counts("t", child, [Reference(("a",), "p", ("id",))], [spark.range(3)])._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and "wide" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            assert "HashAggregate" in lines[i + 1] and "partial" in lines[i + 1]
