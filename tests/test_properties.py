"""Property and invariant checks."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions import half_up_ratio
from strata.operators import gold as G
from strata.queries import RUN_TS, _dim_part, _fct_orders, _src
from tests.conftest import SF_SMALL

BIG = 10**24

pairs = st.lists(
    st.tuples(st.integers(-BIG, BIG), st.integers(-BIG, BIG).filter(lambda d: d != 0), st.integers(0, 3)),
    min_size=1, max_size=200,
)


def _exact(n: int, d: int, scale: int) -> Decimal:
    q = (Decimal(n) / Decimal(d)).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)
    return q


@settings(max_examples=5, deadline=None)
@given(pairs)
def test_half_up_ratio_matches_exact_decimal(spark, rows):
    """All generated cases in one Spark job, compared with Python's exact decimal rounding."""
    df = spark.createDataFrame([(Decimal(n), Decimal(d), s) for n, d, s in rows],
                               "n decimal(38,0), d decimal(38,0), s int")
    exprs = [half_up_ratio(F.col("n"), F.col("d"), s, "decimal(38,3)").alias(f"r{s}") for s in range(4)]
    got = df.select("n", "d", "s", *exprs).collect()
    for r in got:
        want = _exact(int(r.n), int(r.d), r.s)
        assert r[f"r{r.s}"] == want, (r.n, r.d, r.s)


def test_fact_grain_equals_line_count(spark):
    src = _src(spark, SF_SMALL)
    assert _fct_orders(src).count() == src.table("lineitem").count()  # every line has its order


def test_fan_out_rows_equal_offers_per_line(spark):
    """wide rows = sum over lines of max(1, offers of the line's part)  (trap T1)."""
    from strata.queries import _dim_customer

    src = _src(spark, SF_SMALL)
    fct, dc, dp = _fct_orders(src), _dim_customer(src), _dim_part(src)
    wide = G.wide_order_details(fct, dc, dp, RUN_TS)
    offers = dp.groupBy("part_key").count()
    expected = (
        fct.join(offers, "part_key", "left")
        .agg(F.sum(F.coalesce(F.col("count"), F.lit(1))).alias("n"))
        .first().n
    )
    assert wide.count() == expected == 4 * fct.count()


_D = Decimal
_PART = "p_partkey long, p_name string, p_mfgr string, p_brand string, p_type string, p_size int, " \
        "p_container string, p_retailprice decimal(15,2)"
_PS = "ps_partkey long, ps_suppkey long, ps_availqty int, ps_supplycost decimal(15,2)"
_SUP = "s_suppkey long, s_name string, s_nationkey int, s_acctbal decimal(15,2)"
_NAT = "n_nationkey int, n_name string, n_regionkey int"
_REG = "r_regionkey int, r_name string"
_CUST = "c_custkey long, c_name string, c_address string, c_nationkey int, c_phone string, " \
        "c_acctbal decimal(15,2), c_mktsegment string"
_ORD = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice decimal(15,2), " \
       "o_orderdate date, o_orderpriority string"
_LINE = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity decimal(15,2), " \
        "l_extendedprice decimal(15,2), l_discount decimal(15,2), l_tax decimal(15,2), l_returnflag string, " \
        "l_linestatus string, l_shipdate date, l_commitdate date, l_receiptdate date, l_shipmode string"

world = st.fixed_dictionaries({
    "offers": st.lists(st.integers(0, 3), min_size=4, max_size=4),          # offers per part 0..3
    "brands": st.lists(st.sampled_from(["B1", "B2", None]), min_size=4, max_size=4),
    "segments": st.lists(st.sampled_from(["AUTO", "HOUSE", None]), min_size=3, max_size=3),
    "orders": st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["F", "O", None]), st.integers(0, 40)),
                       min_size=1, max_size=6),                             # (customer, status, day)
    "lines": st.lists(st.tuples(st.integers(0, 5), st.integers(0, 4), st.integers(1, 99999),
                                st.integers(0, 10), st.integers(0, 8), st.sampled_from([-3, 5, None])),
                      min_size=1, max_size=25),                             # (order, part, cents, disc, tax, late)
})


@settings(max_examples=4, deadline=None)
@given(world)
def test_weighted_marts_equal_marts_over_fanned_out_table(spark, w):
    import datetime as dt

    from strata.operators import silver as S
    from tests.helpers import spark_table

    part = spark.createDataFrame(
        [(p, f"P{p}", "M", w["brands"][p], "T", 1, "BOX", _D("1.00")) for p in range(4)], _PART)
    partsupp = spark.createDataFrame(
        [(p, s, 1, _D("1.00")) for p in range(4) for s in range(w["offers"][p])], _PS)
    supplier = spark.createDataFrame([(s, f"S{s}", 0, _D("0")) for s in range(3)], _SUP)
    nation = spark.createDataFrame([(0, "N0", 0), (1, "N1", 1)], _NAT)
    region = spark.createDataFrame([(0, "R0")], _REG)
    customer = spark.createDataFrame(  # customer 3 does not exist; customer 2 has an unknown nation
        [(c, f"C{c}", "A", c % 2 if c < 2 else 7, "p", _D("0"), w["segments"][c]) for c in range(3)], _CUST)
    d0 = dt.date(2001, 1, 28)
    orders = spark.createDataFrame(
        [(o, c, s, _D("1"), d0 + dt.timedelta(days=day), "1") for o, (c, s, day) in enumerate(w["orders"])], _ORD)
    lines = spark.createDataFrame(
        [(o, p, 0, i, _D("1"), _D(cents) / 100, _D(disc) / 100, _D(tax) / 100, "N", "O", d0, d0,
          None if late is None else d0 + dt.timedelta(days=late), "AIR")
         for i, (o, p, cents, disc, tax, late) in enumerate(w["lines"])], _LINE)
    fct = S.fct_orders(orders, lines, "t")
    dc = S.dim_customer(customer, nation, region, "t")
    dp = S.dim_part(part, partsupp, supplier, nation, region, "t")
    wide = G.wide_order_details(fct, dc, dp, "t")
    finance, marketing = spark_table(G.finance_metrics(wide, "t", "2002-01-01")), spark_table(G.marketing_metrics(wide, "t"))
    for weighted in (G.mart_lines(fct, dc, dp), G.mart_lines_from_sources(orders, lines, dc, dp)):
        assert spark_table(G.finance_metrics(weighted, "t", "2002-01-01")) == finance
        assert spark_table(G.marketing_metrics(weighted, "t")) == marketing
        assert spark_table(G.top_brands(weighted)) == spark_table(G.top_brands(wide))


mkt_rows = st.lists(
    st.tuples(st.integers(0, 5), st.integers(0, 2), st.sampled_from(["AUTO", "HOUSE", None]),
              st.sampled_from(["B1", "B2", "B3", None]), st.integers(0, 5000), st.sampled_from([True, False, None])),
    min_size=1, max_size=40,
)


@settings(max_examples=4, deadline=None)
@given(mkt_rows)
def test_one_pass_marketing_equals_window_and_join(spark, rows):
    """The grouping-sets mart gives the same rows as the literal plan: per-group metrics
    LEFT JOIN (ROW_NUMBER() ... = 1) on plain equality."""
    import datetime as dt

    lines = spark.createDataFrame(
        [(o, dt.date(2001, 1 + m, 15), seg, brand, _D(c) / 100, late) for o, m, seg, brand, c, late in rows],
        "order_key long, order_date date, market_segment string, brand string, net_amount decimal(18,2), "
        "is_late_delivery boolean",
    )
    got = G.marketing_metrics(lines, "t").drop("etl_inserted")

    by = ["month", "market_segment"]
    base = lines.withColumn("month", F.trunc("order_date", "month").cast("timestamp_ntz"))
    grouped = base.groupBy(*by).agg(
        F.countDistinct("order_key").alias("order_count"),
        F.round(F.sum("net_amount"), 2).cast("decimal(38,2)").alias("total_revenue"),
        F.round(F.avg("net_amount"), 2).cast("decimal(18,2)").alias("avg_order_value"),
        (F.sum(F.when(F.col("is_late_delivery"), 1).otherwise(0)) * 100 / F.count(F.lit(1))).alias("_late"),
    )
    best = G.top_brands(base).where(F.col("rn") == 1).select(
        F.col("month").alias("_m"), F.col("market_segment").alias("_s"), F.col("brand").alias("top_brand"))
    want = grouped.join(best, (F.col("month") == F.col("_m")) & (F.col("market_segment") == F.col("_s")), "left")
    # late rate: exact half-up of the same ratio, compared at 2 decimals
    want = want.select(*by, "order_count", "total_revenue", "avg_order_value",
                       F.col("_late").alias("late_raw"), "top_brand")
    got_rows = {(r.month, r.market_segment): r for r in got.collect()}
    want_rows = {(r.month, r.market_segment): r for r in want.collect()}
    assert got_rows.keys() == want_rows.keys()
    for k, g in got_rows.items():
        w = want_rows[k]
        assert (g.order_count, g.total_revenue, g.avg_order_value, g.top_brand) == \
            (w.order_count, w.total_revenue, w.avg_order_value, w.top_brand), k
        assert abs(g.late_delivery_rate - float(w.late_raw)) <= 0.005 + 1e-9, k
