"""Hand-checked rows for each operator, including the NULL and tie cases
the driver data does not contain."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.functions import half_up_ratio
from strata.operators import gold as G
from strata.operators import silver as S

D = Decimal
RUN = "2023-01-01T12:00:00.000000"

CUSTOMER = "c_custkey long, c_name string, c_address string, c_nationkey int, c_phone string, " \
           "c_acctbal decimal(15,2), c_mktsegment string"
NATION = "n_nationkey int, n_name string, n_regionkey int"
REGION = "r_regionkey int, r_name string"
PART = "p_partkey long, p_name string, p_mfgr string, p_brand string, p_type string, p_size int, " \
       "p_container string, p_retailprice decimal(15,2)"
PARTSUPP = "ps_partkey long, ps_suppkey long, ps_availqty int, ps_supplycost decimal(15,2)"
SUPPLIER = "s_suppkey long, s_name string, s_nationkey int, s_acctbal decimal(15,2)"
ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice decimal(15,2), " \
         "o_orderdate date, o_orderpriority string"
LINEITEM = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity decimal(15,2), " \
           "l_extendedprice decimal(15,2), l_discount decimal(15,2), l_tax decimal(15,2), l_returnflag string, " \
           "l_linestatus string, l_shipdate date, l_commitdate date, l_receiptdate date, l_shipmode string"


@pytest.fixture()
def geo_tables(spark):
    nation = spark.createDataFrame([(1, "ARGENTINA", 1), (2, "NOWHERE", 9)], NATION)
    region = spark.createDataFrame([(1, "AMERICA")], REGION)
    return nation, region


def test_dim_customer_reference_row_and_null_address(spark, geo_tables):
    nation, region = geo_tables
    customer = spark.createDataFrame(
        [
            (1, "Customer#000000001", "Address 1", 1, "25-989-741-2988", D("0.23"), "BUILDING"),
            (2, "Customer#000000002", "Address 2", 7, "11-111-111-1111", D("1.00"), "MACHINERY"),
            (3, "Customer#000000003", "Address 3", 2, "11-111-111-1112", D("2.00"), "MACHINERY"),
        ],
        CUSTOMER,
    )
    rows = {r.customer_key: r for r in S.dim_customer(customer, nation, region, RUN).collect()}
    r1 = rows[1]
    assert (r1.customer_name, r1.nation_name, r1.region_name) == ("Customer#000000001", "ARGENTINA", "AMERICA")
    assert r1.full_address == "Address 1, ARGENTINA, AMERICA"
    assert (r1.phone_number, r1.account_balance, r1.market_segment) == ("25-989-741-2988", D("0.23"), "BUILDING")
    assert r1.etl_inserted == RUN
    # Unknown nation: customer kept, geography and full address NULL.
    assert rows[2].nation_name is None and rows[2].full_address is None
    # Nation without region: region NULL, so the concatenation is NULL too.
    assert rows[3].nation_name == "NOWHERE" and rows[3].region_name is None and rows[3].full_address is None


def test_dim_part_fan_out_and_part_without_offers(spark, geo_tables):
    nation, region = geo_tables
    part = spark.createDataFrame(
        [(10, "p10", "M#1", "Brand#11", "T", 5, "SM BOX", D("100.00")),
         (11, "p11", "M#2", "Brand#12", "T", 6, "MED BAG", D("10.01"))],
        PART,
    )
    partsupp = spark.createDataFrame([(10, 1, 5, D("1.00")), (10, 2, 6, D("2.00"))], PARTSUPP)
    supplier = spark.createDataFrame([(1, "S1", 1, D("5.00")), (2, "S2", 7, D("6.00"))], SUPPLIER)
    rows = S.dim_part(part, partsupp, supplier, nation, region, RUN).collect()
    by_part = {}
    for r in rows:
        by_part.setdefault(r.part_key, []).append(r)
    assert len(by_part[10]) == 2 and len(by_part[11]) == 1
    lone = by_part[11][0]
    assert lone.supplier_name is None and lone.supply_cost is None
    assert lone.wholesale_price == D("8.01")  # 10.01 * 0.8 = 8.008 -> 8.01
    assert {r.manufacturing_country for r in by_part[10]} == {"ARGENTINA", None}
    assert by_part[10][0].category == by_part[10][0].product_type


def _fact_inputs(spark):
    orders = spark.createDataFrame(
        [
            (1, 100, "O", D("10.00"), dt.date(2001, 1, 10), "1-URGENT"),
            (2, 100, "F", D("10.00"), dt.date(2001, 1, 10), "1-URGENT"),
            (3, 999, None, D("10.00"), dt.date(2001, 1, 10), "1-URGENT"),
        ],
        ORDERS,
    )
    lineitem = spark.createDataFrame(
        [
            # ext 1000.05, disc 0.05, tax 0.08 -> net 1026.05, disc 50.00, tax 76.00
            (1, 10, 1, 1, D("1"), D("1000.05"), D("0.05"), D("0.08"), "N", "O",
             dt.date(2001, 1, 5), dt.date(2001, 1, 20), dt.date(2001, 1, 25), "AIR"),
            (1, 11, 1, 2, D("1"), D("100.00"), D("0.00"), D("0.00"), "N", "O",
             dt.date(2001, 1, 12), dt.date(2001, 1, 20), None, "AIR"),
            (2, 10, 2, 1, D("1"), D("50.00"), D("0.10"), D("0.00"), "R", "F",
             dt.date(2001, 1, 11), dt.date(2001, 1, 20), dt.date(2001, 1, 15), "RAIL"),
            (3, 12, 2, 1, D("1"), D("20.00"), D("0.00"), D("0.00"), "R", "F",
             dt.date(2001, 1, 11), dt.date(2001, 1, 20), dt.date(2001, 1, 21), "RAIL"),
            (4, 10, 2, 1, D("1"), D("1.00"), D("0.00"), D("0.00"), "R", "F",
             dt.date(2001, 1, 11), dt.date(2001, 1, 20), dt.date(2001, 1, 21), "RAIL"),
        ],
        LINEITEM,
    )
    return orders, lineitem


def test_fct_orders_amounts_delays_and_late_flag(spark):
    orders, lineitem = _fact_inputs(spark)
    rows = {(r.order_key, r.line_number): r for r in S.fct_orders(orders, lineitem, RUN).collect()}
    assert len(rows) == 4  # line of order 4 has no order: inner join drops it
    r = rows[(1, 1)]
    assert (r.net_amount, r.discount_amount, r.tax_amount) == (D("1026.05"), D("50.00"), D("76.00"))
    assert r.shipping_delay_days == -5 and r.delivery_delay_days == 20 and r.is_late_delivery is True
    assert rows[(1, 2)].is_late_delivery is None and rows[(1, 2)].delivery_delay_days is None
    assert rows[(2, 1)].is_late_delivery is False


@pytest.fixture()
def mart_inputs(spark, geo_tables):
    nation, region = geo_tables
    orders, lineitem = _fact_inputs(spark)
    fct = S.fct_orders(orders, lineitem, RUN)
    customer = spark.createDataFrame(
        [(100, "C100", "A", 1, "p", D("0"), "BUILDING")], CUSTOMER)
    dc = S.dim_customer(customer, nation, region, RUN)
    part = spark.createDataFrame(
        [(10, "p10", "M", "Brand#B", "T", 1, "BOX", D("1.00")),
         (11, "p11", "M", "Brand#A", "T", 1, "BOX", D("1.00"))], PART)
    partsupp = spark.createDataFrame([(10, 1, 1, D("1")), (10, 2, 1, D("1")), (10, 3, 1, D("1"))], PARTSUPP)
    supplier = spark.createDataFrame([(1, "S1", 1, D("1"))], SUPPLIER)
    dp = S.dim_part(part, partsupp, supplier, nation, region, RUN)
    return fct, dc, dp


def test_wide_table_fans_out_per_supplier_offer(mart_inputs):
    fct, dc, dp = mart_inputs
    wide = G.wide_order_details(fct, dc, dp, RUN)
    # part 10 has 3 offers (lines (1,1), (2,1)), part 11 one, part 12 none.
    assert wide.count() == 3 + 1 + 3 + 1
    assert wide.where(F.col("order_key") == 3).first().market_segment is None  # unknown customer


def test_marts_by_weights_equal_marts_over_wide_table(mart_inputs):
    from tests.helpers import spark_table

    fct, dc, dp = mart_inputs
    wide = G.wide_order_details(fct, dc, dp, RUN)
    lines = G.mart_lines(fct, dc, dp)
    assert spark_table(G.finance_metrics(lines, RUN, "2002-01-01")) == \
        spark_table(G.finance_metrics(wide, RUN, "2002-01-01"))
    assert spark_table(G.marketing_metrics(lines, RUN)) == spark_table(G.marketing_metrics(wide, RUN))


def test_finance_metrics_hand_values(mart_inputs):
    fct, dc, dp = mart_inputs
    fm = G.finance_metrics(G.wide_order_details(fct, dc, dp, RUN), RUN, "2001-01-20").collect()
    by = {r.customer_nation: r for r in fm}
    a = by["ARGENTINA"]
    # Order 1 (open): line 1 x3 offers (net 1026.05, ext 1000.05), line 2 x1 (net = ext = 100.00);
    # order 2 (F): line x3 offers (ext 50.00, net 45.00).  7 wide rows.
    assert a.dt == dt.date(2001, 1, 10) and a.customer_region == "AMERICA"
    assert a.total_revenue == D("3313.15")
    assert a.total_discounts == D("165.00")  # 3 x 50.00 (50.0025 rounded) + 3 x 5.00
    assert a.accounts_receivable == D("3178.15")
    assert a.order_count == 2
    assert a.average_order_value == D("473.31")  # 3313.15 / 7 = 473.3071...
    assert a.estimated_margin == D("713.03")  # 3313.15 - 0.8 x 3250.15
    assert a.margin_percentage == 21.52  # 713.03 / 3313.15 = 21.521...%
    assert a.avg_open_order_age == 10.0
    # Unknown customer, NULL status: not receivable, no open age.
    n = by[None]
    assert n.total_revenue == D("20.00") and n.accounts_receivable == D("0.00")
    assert n.avg_open_order_age is None and n.order_count == 1


MART_LINES = "order_key long, order_date date, order_status string, market_segment string, " \
             "customer_nation string, customer_region string, net_amount decimal(18,2), " \
             "extended_price decimal(18,2), tax_amount decimal(18,2), discount_amount decimal(18,2), " \
             "brand string, is_late_delivery boolean"


def test_marketing_top_brand_tie_null_segment_and_late_rate(spark):
    d = dt.date(2001, 2, 3)
    lines = spark.createDataFrame(
        [
            (1, d, "O", "AUTO", "X", "Y", D("1.00"), D("1.00"), D("0"), D("0"), "Brand#Z", True),
            (2, d, "O", "AUTO", "X", "Y", D("2.00"), D("2.00"), D("0"), D("0"), "Brand#A", None),
            (2, d, "O", "AUTO", "X", "Y", D("0.01"), D("0.01"), D("0"), D("0"), None, False),
            (3, d, "O", None, "X", "Y", D("5.00"), D("5.00"), D("0"), D("0"), "Brand#Q", True),
        ],
        MART_LINES,
    )
    rows = {r.market_segment: r for r in G.marketing_metrics(lines, RUN).collect()}
    auto = rows["AUTO"]
    assert auto.month == dt.datetime(2001, 2, 1)
    assert auto.top_brand == "Brand#A"  # tie 1-1 with Brand#Z (NULL brand ranks last): name order
    assert auto.order_count == 2 and auto.total_revenue == D("3.01")
    assert auto.avg_order_value == D("1.00")  # 3.01 / 3 = 1.0033
    assert auto.late_delivery_rate == 33.33  # NULL late flag counts as on time
    # A NULL segment never equals itself: no top brand.
    assert rows[None].top_brand is None and rows[None].order_count == 1


def test_zero_revenue_group_has_null_margin(spark):
    d = dt.date(2001, 2, 3)
    lines = spark.createDataFrame(
        [(1, d, "O", "AUTO", "X", "Y", D("0.00"), D("3.00"), D("0"), D("0"), "B", False)], MART_LINES)
    r = G.finance_metrics(lines, RUN, "2001-03-01").first()
    assert r.total_revenue == D("0.00") and r.margin_percentage is None
    assert r.estimated_margin == D("-2.40")


@pytest.mark.parametrize(
    "num,den,scale,expected",
    [(5, 2, 0, 3.0), (-5, 2, 0, -3.0), (1, 3, 2, 0.33), (2, 3, 2, 0.67), (1, -8, 2, -0.13),
     (7, 0, 2, None), (None, 3, 1, None), (10**20 + 5, 10, 0, float(10**19 + 1))],
)
def test_half_up_ratio_is_exact(spark, num, den, scale, expected):
    df = spark.createDataFrame([(None if num is None else D(num), D(den))], "n decimal(38,0), d decimal(38,0)")
    got = df.select(half_up_ratio(F.col("n"), F.col("d"), scale).alias("r")).first().r
    assert got == expected


def test_half_up_ratio_decimal_output(spark):
    df = spark.createDataFrame([(100001, 200)], "n long, d long")
    r = df.select(half_up_ratio(F.col("n"), F.col("d"), 2, "decimal(18,2)").alias("r")).first().r
    assert r == D("500.01")  # 500.005 -> 500.01


def test_exact_averages_agree_with_builtin_avg(spark):
    """The exact half-up average equals Spark's own round(avg(decimal), 2) on real data."""
    from strata.queries import _fct_orders, _src
    from tests.conftest import SF_SMALL

    fct = _fct_orders(_src(spark, SF_SMALL))
    got = fct.groupBy("order_date").agg(
        half_up_ratio(F.sum((F.col("net_amount") * 100).cast("decimal(38,0)")), F.count("net_amount"), 2,
                      "decimal(18,2)", num_scale=2).alias("mine"),
        F.round(F.avg("net_amount"), 2).cast("decimal(18,2)").alias("builtin"),
    )
    assert got.where(F.col("mine") != F.col("builtin")).count() == 0
    assert got.count() > 100
