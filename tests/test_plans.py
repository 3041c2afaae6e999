"""Plan-shape checks: the scale properties the design relies on, asserted on the physical plan."""

from __future__ import annotations

import contextlib
import io
import re

from strata.queries import QUERIES
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _scans(plan: str, table: str) -> list[str]:
    return [l for l in plan.splitlines() if "FileScan parquet" in l and f"/{table}.parquet" in l]


def test_mart_scans_read_only_the_columns_they_use(spark):
    plan = _plan(QUERIES["finance_metrics"](spark, SF_SMALL))
    line_scans = _scans(plan, "lineitem")
    assert line_scans
    cols = set(re.search(r"FileScan parquet \[([^\]]*)\]", line_scans[0]).group(1).replace(" ", "").split(","))
    cols = {re.sub(r"#\d+L?$", "", c) for c in cols}
    assert cols == {"l_orderkey", "l_partkey", "l_extendedprice", "l_discount", "l_tax"}


def test_marketing_mart_is_one_pass(spark):
    plan = _plan(QUERIES["marketing_metrics"](spark, SF_SMALL)).split("== Initial Plan ==")[0]
    assert len(_scans(plan, "lineitem")) == 1  # the fact is scanned and joined once
    assert plan.count("Expand [") == 1          # one grouping-sets expansion feeds both metric families
    assert "Window" not in plan                  # the top brand is an aggregate, not a second pipeline


def _static(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def test_the_fact_is_read_once(spark):
    for name in ("wide_order_details", "finance_metrics_via_wide", "marketing_metrics_via_wide"):
        plan = _static(QUERIES[name](spark, SF_SMALL))
        assert len(re.findall(r"FileScan parquet \[[^]]*l_orderkey", plan)) == 1, name
        assert "LeftAnti" not in plan, name


def test_bronze_is_a_map_only_copy(spark):
    for name in ("bronze_lineitem", "bronze_orders", "bronze_customer", "bronze_part"):
        assert "Exchange" not in _plan(QUERIES[name](spark, SF_SMALL)), name


def _ancestors(lines: list[str], i: int) -> list[str]:
    """Lines above ``i`` in the printed tree that are its ancestors (strictly smaller indentation)."""
    def depth(l: str) -> int:
        return len(l) - len(l.lstrip(" :+-"))
    out, cur = [], depth(lines[i])
    for line in reversed(lines[:i]):
        d = depth(line)
        if d < cur:
            out.append(line)
            cur = d
    return out


def test_the_fact_is_never_broadcast(spark):
    """No BroadcastExchange anywhere above a lineitem scan: the fact is always the streamed side."""
    for name in ("fct_orders", "wide_order_details", "finance_metrics", "marketing_metrics"):
        lines = _plan(QUERIES[name](spark, SF_SMALL)).split("== Initial Plan ==")[0].splitlines()
        scans = [i for i, l in enumerate(lines) if "FileScan parquet" in l and "/lineitem.parquet" in l]
        assert scans, name
        for i in scans:
            assert not any("BroadcastExchange" in a for a in _ancestors(lines, i)), name


def test_ancestor_check_detects_a_broadcast_fact(spark):
    """Negative control for the check above: a hinted broadcast of lineitem is found."""
    from pyspark.sql import functions as F

    from strata.sources import FixtureSource

    src = FixtureSource(spark, SF_SMALL)
    df = src.table("orders").join(F.broadcast(src.table("lineitem")), F.col("o_orderkey") == F.col("l_orderkey"))
    lines = _plan(df).split("== Initial Plan ==")[0].splitlines()
    i = next(i for i, l in enumerate(lines) if "FileScan parquet" in l and "/lineitem.parquet" in l)
    assert any("BroadcastExchange" in a for a in _ancestors(lines, i))


def _line_exchanges(spark, name: str) -> int:
    """Shuffles of line rows in a query's plan where nothing is small enough to be broadcast but nation and region.

    Every shuffle above the lines' scan with nothing folded on the way, that
    is without an aggregate between the scan and the shuffle.
    """
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    (scan,) = [i for i, l in enumerate(lines) if "FileScan parquet" in l and "/lineitem.parquet" in l and "l_extendedprice" in l]
    above = _ancestors(lines, scan)
    first = next((i for i, a in enumerate(above) if "Aggregate" in a), len(above))
    partial = first + 1 if first + 1 < len(above) and "Exchange" in above[first + 1] else first  # a shuffle of rows that the marts fold by order alone counts
    return sum("Exchange hashpartitioning" in a for a in above[:partial + 1])


def test_marts_from_sources_shuffle_the_lines_twice(spark):
    """By part for the offers and by order; the fold by group and order needs no shuffle.  From the fact it takes two more."""
    assert _line_exchanges(spark, "finance_metrics") == 2
    assert _line_exchanges(spark, "finance_metrics_via_fact") == 4
    assert _line_exchanges(spark, "marketing_metrics") < _line_exchanges(spark, "marketing_metrics_via_fact")


def test_a_hot_order_is_split(spark, tmp_path):
    """An order key that holds most lines: AQE splits its partition of the line side of J7 (``skew=true``), and the rows stay right."""
    from pyspark.sql import functions as F

    from strata.operators import silver as S
    from strata.sources import FixtureSource

    src = FixtureSource(spark, SF_SMALL)
    lines = src.table("lineitem").crossJoin(spark.range(20).select("id")).drop("id").withColumn("l_orderkey", F.when(F.rand(7) < 0.7, F.lit(1)).otherwise(F.col("l_orderkey")))
    lines.repartition(12).write.parquet(f"file://{tmp_path}/hot")  # a partition is split by the map tasks it comes from
    lines = spark.read.parquet(f"file://{tmp_path}/hot")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fct = S.fct_orders(src.table("orders"), lines, "t")
        rows = fct.groupBy("order_key").count().collect()
        fct.collect()
        assert "skew=true" in fct._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    want = {r[0]: r[1] for r in lines.join(src.table("orders").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("l_orderkey").count().collect()}
    assert {r[0]: r[1] for r in rows} == want


def test_bucketed_orders_and_lines_join_without_a_shuffle(spark):
    from strata.queries import BUCKETS

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fct = QUERIES["fct_orders_bucketed"](spark, SF_SMALL)
        plan = _plan(fct)
        per_order = _plan(fct.groupBy("order_key").count())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and f"SelectedBucketsCount: {BUCKETS} out of {BUCKETS}" in plan
    assert "Exchange" not in per_order


def test_buckets_grow_with_the_lines(spark, tmp_path, monkeypatch):
    """A bucket, and with it the task that sorts it, keeps its size; both tables have the same number of buckets."""
    from strata import queries

    assert [queries.bucket_count(n) for n in (0, 64 << 20, 648 << 20, 4 << 30, 1 << 60)] == [8, 8, 81, 512, 100_000]
    monkeypatch.setattr(queries, "BUCKET_BYTES", 8 << 10)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fct = queries.q_fct_orders_bucketed(spark, SF_SMALL)
        plan, rows = _plan(fct), fct.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    n = int(re.search(r"SelectedBucketsCount: (\d+) out of", plan).group(1))
    assert n > queries.BUCKETS and plan.count(f"SelectedBucketsCount: {n} out of {n}") == 2 and "Exchange" not in plan
    assert rows == queries.q_fct_orders(spark, SF_SMALL).count()


def test_parts_travel_by_their_own_key_alone(spark):
    """Suppliers join the offers' few columns, not rows that carry the part's names already."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = QUERIES["dim_part"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    (scan,) = [i for i, l in enumerate(lines) if "FileScan parquet" in l and "p_name" in l]
    assert sum("Exchange hashpartitioning" in a for a in _ancestors(lines, scan)) == 1


def test_the_wide_table_at_grain_shuffles_the_lines_twice(spark):
    """By offer as bare lines, and by order with the names of the part; customers travel with the orders."""
    for name in ("wide_order_details_at_grain", "wide_order_details_misses"):
        assert _line_exchanges(spark, name) == 2, name


def test_the_wide_table_from_sources_is_that_of_the_fact(spark):
    """With keys that are null, repeat or lead nowhere on every side."""
    from pyspark.sql import functions as F

    from strata.operators import gold as G
    from strata.operators import silver as S
    from strata.sources import FixtureSource

    src = FixtureSource(spark, SF_SMALL, "lines")

    def odd(df, *keys):
        for i, k in enumerate(keys):
            df = df.withColumn(k, F.when(F.col(k) % 11 != i, F.col(k)))
        return df.unionByName(df.where(F.col(keys[-1]) % 3 == 0))

    lines, orders = odd(src.table("lineitem"), "l_orderkey", "l_partkey", "l_suppkey"), odd(src.table("orders"), "o_orderkey", "o_custkey")
    geo = src.table("nation"), src.table("region")
    customers = S.dim_customer(odd(src.table("customer"), "c_custkey"), *geo, "t")
    parts = S.dim_part(odd(src.table("part"), "p_partkey"), odd(src.table("partsupp"), "ps_partkey", "ps_suppkey"), odd(src.table("supplier"), "s_suppkey"), *geo, "t", with_supplier_key=True)
    want = G.wide_order_details(S.fct_orders(orders, lines, "t"), customers, parts, "t", "part_supplier")
    got = G.wide_order_details_from_sources(orders, lines, customers, parts, "t")
    assert got.columns == want.columns and got.count() == want.count() > 0
    assert got.exceptAll(want).isEmpty()


def test_catalog_names_follow_the_published_stamp(spark, tmp_root):
    from strata.plans.catalog import Catalog
    from strata.plans.snapshots import SnapshotStore

    store, catalog = SnapshotStore(spark, tmp_root + "/lake"), Catalog(spark, "strata_names", tmp_root + "/db")
    name = None
    for stamp, n in (("2023-01-01", 3), ("it's", 5)):
        name = catalog.publish_snapshot(store, store.write_stamp(spark.range(n), "gold", "m", stamp))
        other = spark.newSession().table(name)
        assert other.count() == n and {r.etl_inserted for r in other.collect()} == {stamp}
    assert len([t for t in spark.catalog.listTables("strata_names") if not t.isTemporary]) == 2 and store.read_partition("gold", "m", {"etl_inserted": "2023-01-01"}).count() == 3
    store.write_stamp(spark.range(1), "gold", "m", "j")  # sorts last
    assert catalog.publish_latest(store, {"m": "gold"}) == [name] and spark.table(name).count() == 1
    assert spark.table(catalog.publish_view("v", "m", [("id", "Größe `x`")])).columns == ["Größe `x`"]
    spark.sql("DROP DATABASE strata_names CASCADE")
