"""Gold layer: the wide order table and the finance and marketing marts.

The wide table joins each order line to its customer and to ``dim_part`` on
``part_key`` alone.  ``dim_part`` has one row per supplier offer, so a line
repeats once per offer of its part and sums grow with it (the reference
semantics, kept).  ``part_match="part_supplier"`` joins at the fact's grain
instead.

The marts accept an optional integer ``weight`` column: a row with weight k
counts as k identical rows.  ``mart_lines`` builds such a frame straight from
the silver tables, with the offer count per part as the weight, so the marts
give the same numbers as over the fanned-out wide table without ever
materialising the fan-out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import CENTS, TOTAL, cents, half_up_ratio, month_start, rounded_money
from strata.operators import silver as S
from strata.schemas import STAMP

PART_MATCHES = ("part", "part_supplier")

WIDE_COLUMNS = (
    "order_key", "line_number", "order_date", "order_status", "order_priority", "extended_price",
    "net_amount", "discount_amount", "tax_amount", "customer_name", "market_segment", "customer_nation",
    "customer_region", "part_name", "manufacturer", "brand", "product_type", "manufacturing_country",
    "manufacturing_region", "shipping_delay_days", "delivery_delay_days", "is_late_delivery",
)

PART_ATTRIBUTES = ("part_name", "manufacturer", "brand", "product_type", "manufacturing_country", "manufacturing_region")

WEIGHT = "_weight"


def _customer_side(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.select(
        F.col("customer_key").alias("_c_key"),
        "customer_name",
        "market_segment",
        F.col("nation_name").alias("customer_nation"),
        F.col("region_name").alias("customer_region"),
    )


def customer_lines(fct: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Order lines with the customer's name, segment, nation and region (no part join)."""
    return fct.join(_customer_side(dim_customer), F.col("customer_key") == F.col("_c_key"), "left").drop("_c_key")


def wide_order_details(
    fct: DataFrame,
    dim_customer: DataFrame,
    dim_part: DataFrame,
    run_ts: str,
    part_match: str = "part",
) -> DataFrame:
    """One-big-table of order lines with customer and part attributes."""
    if part_match not in PART_MATCHES:
        raise ValueError(f"part_match must be one of {PART_MATCHES}, got {part_match!r}")
    part_cols = PART_ATTRIBUTES
    if part_match == "part":
        p = dim_part.select(F.col("part_key").alias("_p_key"), *part_cols)
        lkeys, rkeys = ["part_key"], ["_p_key"]
    else:
        p = dim_part.select(F.col("part_key").alias("_p_key"), F.col("supplier_key").alias("_s_key"), *part_cols)
        lkeys, rkeys = ["part_key", "supplier_key"], ["_p_key", "_s_key"]
    # The fact is the preserved side: it is read and shuffled once, and AQE may split its hot parts.
    on = [F.col(l) == F.col(r) for l, r in zip(lkeys, rkeys)]
    return customer_lines(fct, dim_customer).join(p, on, "left").select(
        *WIDE_COLUMNS, F.lit(run_ts).alias(STAMP))


def wide_order_details_from_sources(orders: DataFrame, lineitem: DataFrame, dim_customer: DataFrame, dim_part: DataFrame, run_ts: str) -> DataFrame:
    """``wide_order_details`` by part and supplier, over the fact of the given sources, with the joins in the order of their sizes.

    Customers are joined to orders, a quarter of the lines; offers to the
    source lines, before these carry anything else; and lines to orders last.
    Lines shuffle twice instead of three times, and only once with the names
    that the joins add.  Not for the match by part alone, where the lines
    would fan out before their last shuffle.
    """
    customers = _customer_side(dim_customer)
    known = orders.join(customers, F.col("o_custkey") == F.col("_c_key"), "left").drop("_c_key")
    offers = dim_part.select(F.col("part_key").alias("_p_key"), F.col("supplier_key").alias("_s_key"), *PART_ATTRIBUTES)
    lines = lineitem.join(offers, (F.col("l_partkey") == F.col("_p_key")) & (F.col("l_suppkey") == F.col("_s_key")), "left").drop("_p_key", "_s_key")
    carried = [c for c in customers.columns if c != "_c_key"]
    return S.fct_orders(known, lines, run_ts, (*carried, *PART_ATTRIBUTES)).select(*WIDE_COLUMNS, STAMP)


def _offers(dim_part: DataFrame, part_match: str, part_col: str, supplier_col: str) -> tuple[DataFrame, Column]:
    """Offers per part (and supplier) and brand, and the condition that joins them to lines with the given key columns."""
    if part_match not in PART_MATCHES:
        raise ValueError(f"part_match must be one of {PART_MATCHES}, got {part_match!r}")
    keys = [F.col("part_key").alias("_p_key")]
    cond = F.col(part_col) == F.col("_p_key")
    if part_match == "part_supplier":
        keys.append(F.col("supplier_key").alias("_s_key"))
        cond = cond & (F.col(supplier_col) == F.col("_s_key"))
    return dim_part.groupBy(*keys, "brand").agg(F.count(F.lit(1)).alias("_offers")), cond


MART_COLUMNS = ("order_key", "order_date", "order_status", "extended_price", "net_amount", "discount_amount", "tax_amount",
                "is_late_delivery", "customer_name", "market_segment", "customer_nation", "customer_region", "brand", WEIGHT)


def mart_lines_from_sources(orders: DataFrame, lineitem: DataFrame, dim_customer: DataFrame, dim_part: DataFrame, part_match: str = "part") -> DataFrame:
    """The lines of ``mart_lines``, with its joins in the order of their sizes.

    Customers are joined to orders, a quarter of the lines; offers to the
    source lines; and lines to orders last, on the order key.  Lines shuffle
    twice (once where the offers are small enough to be broadcast) instead of
    three times, and since they end up dealt by order, the marts' first
    aggregate, by group and order, needs no shuffle of its own.
    """
    offers, cond = _offers(dim_part, part_match, "l_partkey", "l_suppkey")
    customers = _customer_side(dim_customer)
    known = orders.join(customers, F.col("o_custkey") == F.col("_c_key"), "left").drop("_c_key")
    lines = lineitem.join(offers, cond, "left").withColumn(WEIGHT, F.coalesce(F.col("_offers"), F.lit(1).cast("bigint"))).drop("_p_key", "_s_key", "_offers")
    carried = [c for c in customers.columns if c != "_c_key"]
    return S.fct_orders(known, lines, "", (*carried, "brand", WEIGHT)).select(*MART_COLUMNS)


def mart_lines(fct: DataFrame, dim_customer: DataFrame, dim_part: DataFrame, part_match: str = "part") -> DataFrame:
    """Order lines with customer attributes, brand and a fan-out weight.

    Equivalent, for every mart aggregate, to the wide table: each line
    carries ``_weight`` = number of ``dim_part`` rows it would match (per
    brand), or 1 when it matches none (the left join keeps it once).  The
    weights table has at most one row per (part[, supplier], brand), so the
    fact is joined once, without growth.
    """
    offers, cond = _offers(dim_part, part_match, "part_key", "supplier_key")
    return (
        fct.select("order_key", "order_date", "order_status", "extended_price", "net_amount", "discount_amount",
                   "tax_amount", "customer_key", "part_key", "supplier_key", "is_late_delivery")
        .join(_customer_side(dim_customer), F.col("customer_key") == F.col("_c_key"), "left")
        .join(offers, cond, "left")
        .withColumn(WEIGHT, F.coalesce(F.col("_offers"), F.lit(1).cast("bigint")))
        .drop("_c_key", "_p_key", "_s_key", "_offers", "customer_key", "part_key", "supplier_key")
    )


def _w(df: DataFrame) -> Column | None:
    return F.col(WEIGHT) if WEIGHT in df.columns else None


def _wsum(x: Column, w: Column | None) -> Column:
    return F.sum(x) if w is None else F.sum(x * w)


def _wcount(x: Column, w: Column | None) -> Column:
    return F.count(x) if w is None else F.sum(F.when(x.isNotNull(), w))


def finance_metrics(lines: DataFrame, run_ts: str, as_of: Column | str | None = None) -> DataFrame:
    """Daily revenue, tax, discounts, receivables and margin per customer nation/region.

    ``as_of`` fixes "today" for the open-order age (default: the current
    date, which makes the metric change daily).  Open orders are those with
    ``order_status != 'F'``; a NULL status is not open.
    """
    w = _w(lines)
    today = F.current_date() if as_of is None else (F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of)
    net, ext = F.col("net_amount"), F.col("extended_price")
    is_open = F.col("order_status") != F.lit("F")
    age = F.datediff(today, F.col("order_date")).cast("bigint")
    sum_net = _wsum(net, w)
    sum_ext = _wsum(ext, w)
    return (
        lines.groupBy(F.col("order_date").cast("date").alias("dt"), "customer_nation", "customer_region")
        .agg(
            rounded_money(sum_net, 2, TOTAL).alias("total_revenue"),
            rounded_money(_wsum(F.col("tax_amount"), w), 2, TOTAL).alias("total_tax"),
            rounded_money(_wsum(F.col("discount_amount"), w), 2, TOTAL).alias("total_discounts"),
            rounded_money(_wsum(F.when(is_open, net).otherwise(F.lit(0).cast(CENTS)), w), 2, TOTAL)
            .alias("accounts_receivable"),
            F.countDistinct("order_key").alias("order_count"),
            half_up_ratio(_wsum(cents(net), w), _wcount(net, w), 2, CENTS, num_scale=2).alias("average_order_value"),
            rounded_money(sum_net - sum_ext * F.lit(0.8).cast("decimal(1,1)"), 2, TOTAL).alias("estimated_margin"),
            # (N - 0.8 E) / N * 100 with N, E in cents: (100 N - 80 E) / N.
            half_up_ratio(cents(sum_net) * 100 - cents(sum_ext) * 80, cents(sum_net), 2).alias("margin_percentage"),
            half_up_ratio(_wsum(F.when(is_open, age), w), _wcount(F.when(is_open, age), w), 1)
            .alias("avg_open_order_age"),
        )
        .withColumn(STAMP, F.lit(run_ts))
    )


def _month_lines(lines: DataFrame) -> DataFrame:
    return lines.withColumn("month", month_start("order_date"))


def top_brands(lines: DataFrame, by: Sequence[str] = ("month", "market_segment")) -> DataFrame:
    """Brand order-line counts per group, ranked (``rn`` 1 = most lines).

    Ties are broken by brand name so the result is deterministic.  The
    window runs on the aggregated (group, brand) rows, never on line rows.
    """
    w = _w(lines)
    if "month" in by and "month" not in lines.columns:
        lines = _month_lines(lines)
    counts = lines.groupBy(*by, "brand").agg(
        (F.count(F.lit(1)) if w is None else F.sum(w)).alias("brand_orders")
    )
    rank = Window.partitionBy(*by).orderBy(F.col("brand_orders").desc(), F.col("brand").asc_nulls_last())
    return counts.withColumn("rn", F.row_number().over(rank))


def marketing_metrics(lines: DataFrame, run_ts: str, by: Sequence[str] = ("month", "market_segment")) -> DataFrame:
    """Monthly orders, revenue, average line value, late rate and top brand per segment.

    One pass over the lines: a grouping-sets aggregate yields, from the same
    scan and joins, one row per (group, order) for the order metrics and one
    row per (group, brand) for the brand counts; a second aggregate folds
    both into one row per group.  The top brand is the brand with most lines,
    ties broken by name (NULL brand last), i.e. ``ROW_NUMBER() OVER (...
    ORDER BY count DESC, brand) = 1``.  As in the original left join on
    plain equality, a group with a NULL key gets no top brand.
    """
    w = _w(lines)
    lines = _month_lines(lines)
    net = F.col("net_amount")
    late = F.when(F.col("is_late_delivery"), F.lit(1)).otherwise(F.lit(0))
    rows = F.count(F.lit(1)) if w is None else F.sum(w)
    per = lines.groupingSets([[*by, "order_key"], [*by, "brand"]], *by, "order_key", "brand").agg(
        F.grouping("brand").alias("_order_level"),
        _wsum(net, w).alias("_net"),
        _wsum(cents(net), w).alias("_cents"),
        _wcount(net, w).alias("_n_net"),
        _wsum(late, w).alias("_late"),
        rows.alias("_rows"),
    )
    order_level = F.col("_order_level") == 1

    def o(c: str) -> Column:
        return F.when(order_level, F.col(c))

    best = F.min(F.when(~order_level, F.struct((-F.col("_rows")).alias("r"),
                                                 F.col("brand").isNull().alias("z"), F.col("brand").alias("b"))))
    keys_present = None
    for c in by:
        e = F.col(c).isNotNull()
        keys_present = e if keys_present is None else keys_present & e
    return (
        per.groupBy(*by)
        .agg(
            F.count(o("order_key")).alias("order_count"),
            rounded_money(F.sum(o("_net")), 2, TOTAL).alias("total_revenue"),
            half_up_ratio(F.sum(o("_cents")), F.sum(o("_n_net")), 2, CENTS, num_scale=2).alias("avg_order_value"),
            half_up_ratio(F.sum(o("_late")) * 100, F.sum(o("_rows")), 2).alias("late_delivery_rate"),
            best.alias("_best"),
        )
        .select(*by, "order_count", "total_revenue", "avg_order_value", "late_delivery_rate",
                F.when(keys_present, F.col("_best.b")).alias("top_brand"))
        .withColumn(STAMP, F.lit(run_ts))
    )
