"""Silver layer: customer and part dimensions, order-line fact.

Join strategy is left to the planner: a side is broadcast only when its
size estimate is under ``spark.sql.autoBroadcastJoinThreshold`` (statically,
from file sizes) or, under AQE, when its measured shuffle output is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``.  Nation and region (25
and 5 rows at every scale) always qualify; customer, part, partsupp,
supplier and orders grow with the data and fall back to shuffle joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import CENTS, day_diff, rounded_money
from strata.schemas import STAMP


def geo(nation: DataFrame, region: DataFrame, nation_label: str, region_label: str) -> DataFrame:
    """Nation with its region name (left join: a nation without region keeps NULL)."""
    return (
        nation.join(region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("n_nationkey", F.col("n_name").alias(nation_label), F.col("r_name").alias(region_label))
    )


def dim_customer(customer: DataFrame, nation: DataFrame, region: DataFrame, run_ts: str) -> DataFrame:
    """One row per customer with nation, region and a display address.

    ``full_address`` is NULL when any part is NULL (SQL ``||``), e.g. for a
    customer whose nation is unknown.
    """
    g = geo(nation, region, "nation_name", "region_name")
    return (
        customer.join(g, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_key"),
            F.col("c_name").alias("customer_name"),
            F.col("c_address").alias("street_address"),
            "nation_name",
            "region_name",
            F.concat(F.col("c_address"), F.lit(", "), F.col("nation_name"), F.lit(", "), F.col("region_name"))
            .alias("full_address"),
            F.col("c_phone").alias("phone_number"),
            F.col("c_acctbal").alias("account_balance"),
            F.col("c_mktsegment").alias("market_segment"),
            F.lit(run_ts).alias(STAMP),
        )
    )


def supplier_enriched(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    g = geo(nation, region, "manufacturing_country", "manufacturing_region")
    return supplier.join(g, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        "s_suppkey",
        F.col("s_name").alias("supplier_name"),
        F.col("s_acctbal").alias("supplier_account_balance"),
        "manufacturing_country",
        "manufacturing_region",
    )


PART_COLUMNS = (
    "part_key", "part_name", "manufacturer", "brand", "product_type", "size", "container_type",
    "category", "packaging", "retail_price", "wholesale_price",
)


def part_transformed(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("part_key"),
        F.col("p_name").alias("part_name"),
        F.col("p_mfgr").alias("manufacturer"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("product_type"),
        F.col("p_size").alias("size"),
        F.col("p_container").alias("container_type"),
        F.col("p_type").alias("category"),
        F.col("p_container").alias("packaging"),
        F.col("p_retailprice").alias("retail_price"),
        rounded_money(F.col("p_retailprice") * F.lit(0.8).cast("decimal(1,1)"), 2, "decimal(17,2)")
        .alias("wholesale_price"),
    )


def dim_part(
    part: DataFrame,
    partsupp: DataFrame,
    supplier: DataFrame,
    nation: DataFrame,
    region: DataFrame,
    run_ts: str,
    with_supplier_key: bool = False,
) -> DataFrame:
    """One row per (part, supplier offer); a part without offers keeps one row.

    The declared key is ``part_key`` but it is not unique: a part has one row
    per partsupp entry.  ``with_supplier_key`` adds ``supplier_key`` so a
    fact can join at its own grain, (part, supplier).

    Suppliers are joined to the offers' few columns first, so the parts' wide
    rows travel by the part key alone.
    """
    pt = part_transformed(part)
    ps = partsupp.select("ps_partkey", "ps_suppkey", "ps_supplycost", "ps_availqty")
    se = supplier_enriched(supplier, nation, region)
    offers = ps.join(se, F.col("ps_suppkey") == F.col("s_suppkey"), "left")
    joined = pt.join(offers, F.col("part_key") == F.col("ps_partkey"), "left")
    cols = [
        *PART_COLUMNS,
        F.col("ps_supplycost").alias("supply_cost"),
        F.col("ps_availqty").alias("available_qty"),
        "supplier_name",
        "supplier_account_balance",
        "manufacturing_country",
        "manufacturing_region",
    ]
    if with_supplier_key:
        cols.append(F.col("ps_suppkey").alias("supplier_key"))
    return joined.select(*cols, F.lit(run_ts).alias(STAMP))


def fct_orders(orders: DataFrame, lineitem: DataFrame, run_ts: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per order line, with amounts, delays and the late flag.

    Inner join: a line without its order is dropped.  Both inputs shuffle on
    the order key (the largest join of the pipeline); AQE splits a hot
    order's partition on the line side.  ``keep`` names further columns of
    either input that the rows carry along.
    """
    l, o = lineitem, orders
    one = F.lit(1).cast("decimal(1,0)")
    ext, disc, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return l.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "inner").select(
        F.col("o_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("o_custkey").alias("customer_key"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supplier_key"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_shipdate").alias("ship_date"),
        F.col("l_commitdate").alias("commit_date"),
        F.col("l_receiptdate").alias("receipt_date"),
        F.col("o_totalprice").alias("order_total_amount"),
        F.col("o_orderpriority").alias("order_priority"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("l_quantity").alias("quantity"),
        ext.alias("extended_price"),
        disc.alias("discount_percentage"),
        tax.alias("tax_percentage"),
        F.col("l_shipmode").alias("ship_mode"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_linestatus").alias("line_status"),
        rounded_money(ext * (one - disc) * (one + tax), 2, CENTS).alias("net_amount"),
        rounded_money(ext * disc, 2, CENTS).alias("discount_amount"),
        rounded_money(ext * (one - disc) * tax, 2, CENTS).alias("tax_amount"),
        day_diff("o_orderdate", "l_shipdate").alias("shipping_delay_days"),
        day_diff("l_shipdate", "l_receiptdate").alias("delivery_delay_days"),
        (F.col("l_receiptdate") > F.col("l_commitdate")).alias("is_late_delivery"),
        *keep,
        F.lit(run_ts).alias(STAMP),
    )
