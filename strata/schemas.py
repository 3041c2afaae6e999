"""Source-table schemas (TPC-H DDL) and type helpers.

Keys are ``bigint``: at 100 TB scale order and line keys pass 2^31.  Small
dimension keys (nation, region), sizes and line numbers stay ``int``.
Money, quantity, discount and tax are ``decimal(15,2)``; dates are ``date``.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, I, L, D, DT = T.StringType(), T.IntegerType(), T.LongType(), MONEY, T.DateType()

# Column order follows the TPC-H DDL, which is also the `.tbl` field order.
SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "nation": _schema(("n_nationkey", I), ("n_name", S), ("n_regionkey", I), ("n_comment", S)),
    "region": _schema(("r_regionkey", I), ("r_name", S), ("r_comment", S)),
    "part": _schema(
        ("p_partkey", L), ("p_name", S), ("p_mfgr", S), ("p_brand", S), ("p_type", S),
        ("p_size", I), ("p_container", S), ("p_retailprice", D), ("p_comment", S),
    ),
    "supplier": _schema(
        ("s_suppkey", L), ("s_name", S), ("s_address", S), ("s_nationkey", I),
        ("s_phone", S), ("s_acctbal", D), ("s_comment", S),
    ),
    "partsupp": _schema(
        ("ps_partkey", L), ("ps_suppkey", L), ("ps_availqty", I), ("ps_supplycost", D), ("ps_comment", S),
    ),
    "customer": _schema(
        ("c_custkey", L), ("c_name", S), ("c_address", S), ("c_nationkey", I), ("c_phone", S),
        ("c_acctbal", D), ("c_mktsegment", S), ("c_comment", S),
    ),
    "orders": _schema(
        ("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
        ("o_orderdate", DT), ("o_orderpriority", S), ("o_clerk", S), ("o_shippriority", I), ("o_comment", S),
    ),
    "lineitem": _schema(
        ("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
        ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
        ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", DT), ("l_commitdate", DT),
        ("l_receiptdate", DT), ("l_shipinstruct", S), ("l_shipmode", S), ("l_comment", S),
    ),
}

# Declared primary keys of the source tables (metadata; checked by quality.key_report).
SOURCE_KEYS: dict[str, tuple[str, ...]] = {
    "customer": ("c_custkey",),
    "lineitem": ("l_orderkey", "l_linenumber"),
    "nation": ("n_nationkey",),
    "orders": ("o_orderkey",),
    "part": ("p_partkey",),
    "partsupp": ("ps_partkey", "ps_suppkey"),
    "region": ("r_regionkey",),
    "supplier": ("s_suppkey",),
}

# Blank-padded CHAR(n) columns: a JDBC read returns the padding, so they are
# right-trimmed at bronze.
CHAR_COLUMNS: dict[str, tuple[str, ...]] = {
    "nation": ("n_name",),
    "region": ("r_name",),
    "part": ("p_mfgr", "p_brand", "p_container"),
    "supplier": ("s_name", "s_phone"),
    "customer": ("c_phone", "c_mktsegment"),
    "orders": ("o_orderstatus", "o_orderpriority", "o_clerk"),
    "lineitem": ("l_returnflag", "l_linestatus", "l_shipinstruct", "l_shipmode"),
}

SOURCE_TABLES: tuple[str, ...] = tuple(SOURCE_SCHEMAS)

# The run stamp column that partitions every stored snapshot.
STAMP = "etl_inserted"

# Declared foreign keys of the source tables: (columns, parent, parent columns).
SOURCE_REFERENCES: dict[str, tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...]] = {
    "nation": ((("n_regionkey",), "region", ("r_regionkey",)),),
    "customer": ((("c_nationkey",), "nation", ("n_nationkey",)),),
    "supplier": ((("s_nationkey",), "nation", ("n_nationkey",)),),
    "partsupp": ((("ps_partkey",), "part", ("p_partkey",)), (("ps_suppkey",), "supplier", ("s_suppkey",))),
    "orders": ((("o_custkey",), "customer", ("c_custkey",)),),
    "lineitem": (
        (("l_orderkey",), "orders", ("o_orderkey",)),
        (("l_partkey",), "part", ("p_partkey",)),
        (("l_suppkey",), "supplier", ("s_suppkey",)),
        (("l_partkey", "l_suppkey"), "partsupp", ("ps_partkey", "ps_suppkey")),
    ),
}
