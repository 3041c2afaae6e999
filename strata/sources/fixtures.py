"""Driver test data as TPC-H source tables.

The driver's Parquet tables carry money as ``double``, dates as timestamps
and lack some TPC-H columns (and ``partsupp``).  This source casts them to
the DDL types and fills the gaps with deterministic surrogates.  The
surrogates are test inputs only.

Each projection is plain SQL expression text, valid in Spark SQL and in the
DuckDB oracle alike, so the same text feeds ``selectExpr`` here and the
oracle queries in ``strata.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Surrogate formulas and casts for the driver data.  They must
# stay exactly as written; the oracle uses the same text.
# ---------------------------------------------------------------------------
FIXTURE_PROJECTIONS: dict[str, tuple[str, ...]] = {
    "region": (
        "r_regionkey",
        "r_name",
    ),
    "nation": (
        "n_nationkey",
        "n_name",
        "n_regionkey",
    ),
    "customer": (
        "c_custkey",
        "c_name",
        "concat('Address ', CAST(c_custkey AS STRING)) AS c_address",
        "c_nationkey",
        "concat(CAST(c_nationkey + 10 AS STRING), '-', CAST(100 + c_custkey % 900 AS STRING), '-', "
        "CAST(1000 + c_custkey % 9000 AS STRING)) AS c_phone",
        "CAST(c_acctbal AS DECIMAL(15,2)) AS c_acctbal",
        "c_mktsegment",
    ),
    "supplier": (
        "s_suppkey",
        "s_name",
        "s_nationkey",
        "CAST(s_acctbal AS DECIMAL(15,2)) AS s_acctbal",
    ),
    "part": (
        "p_partkey",
        "p_name",
        "concat('Manufacturer#', CAST(p_partkey % 5 + 1 AS STRING)) AS p_mfgr",
        "p_brand",
        "p_type",
        "p_size",
        "CASE p_size % 4 WHEN 0 THEN 'SM BOX' WHEN 1 THEN 'MED BAG' WHEN 2 THEN 'LG CASE' "
        "ELSE 'JUMBO PKG' END AS p_container",
        "CAST(p_retailprice AS DECIMAL(15,2)) AS p_retailprice",
    ),
    "orders": (
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice",
        "CAST(o_orderdate AS DATE) AS o_orderdate",
        "o_orderpriority",
    ),
    "lineitem": (
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "CAST(l_quantity AS DECIMAL(15,2)) AS l_quantity",
        "CAST(l_extendedprice AS DECIMAL(15,2)) AS l_extendedprice",
        "CAST(l_discount AS DECIMAL(15,2)) AS l_discount",
        "CAST(l_tax AS DECIMAL(15,2)) AS l_tax",
        "l_returnflag",
        "l_linestatus",
        "CAST(l_shipdate AS DATE) AS l_shipdate",
        "CAST(l_shipdate AS DATE) + CAST((l_orderkey + l_linenumber * 7) % 30 - 10 AS INT) AS l_commitdate",
        "CAST(l_shipdate AS DATE) + CAST((l_orderkey + l_partkey) % 30 + 1 AS INT) AS l_receiptdate",
        "CASE CAST(l_orderkey % 7 AS INT) WHEN 0 THEN 'REG AIR' WHEN 1 THEN 'AIR' WHEN 2 THEN 'RAIL' "
        "WHEN 3 THEN 'SHIP' WHEN 4 THEN 'TRUCK' WHEN 5 THEN 'MAIL' ELSE 'FOB' END AS l_shipmode",
    ),
}

# partsupp surrogates.  "four": four suppliers per part, spread over the
# supplier key range (n = supplier count).  "lines": every (part, supplier)
# pair that occurs on a line item.
PARTSUPP_FOUR_SUPPKEY = "(p_partkey + i * CAST(floor(n / 4) AS BIGINT)) % n"
PARTSUPP_FOUR_AVAILQTY = "CAST((p_partkey * 7 + i * 13) % 9999 + 1 AS INT)"
PARTSUPP_FOUR_SUPPLYCOST = "CAST(CAST((p_partkey * 31 + i * 17) % 99900 + 100 AS DECIMAL(15,0)) * 0.01 AS DECIMAL(15,2))"
PARTSUPP_FOUR_SUPPLIERS_PER_PART = 4
PARTSUPP_LINES_AVAILQTY = "CAST((l_partkey * 7 + l_suppkey * 13) % 9999 + 1 AS INT)"
PARTSUPP_LINES_SUPPLYCOST = (
    "CAST(CAST((l_partkey * 31 + l_suppkey * 17) % 99900 + 100 AS DECIMAL(15,0)) * 0.01 AS DECIMAL(15,2))"
)

PARTSUPP_MODES = ("four", "lines")


class FixtureSource:
    """Reads ``{sf_dir}/{table}.parquet`` and returns TPC-H typed tables.

    ``partsupp`` selects the partsupp surrogate: ``"four"`` (reference
    semantics: several suppliers per part) or ``"lines"`` (one row per
    (part, supplier) pair sold, for the grain-safe wide table).
    """

    name = "fixture"

    def __init__(self, spark: SparkSession, sf_dir: str, partsupp: str = "four") -> None:
        if partsupp not in PARTSUPP_MODES:
            raise ValueError(f"partsupp must be one of {PARTSUPP_MODES}, got {partsupp!r}")
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.partsupp_mode = partsupp
        self._tables: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        """The typed table; built once per source (DataFrames are immutable plans)."""
        if name not in self._tables:
            if name == "partsupp":
                self._tables[name] = self._partsupp()
            elif name in FIXTURE_PROJECTIONS:
                self._tables[name] = self.raw(name).selectExpr(*FIXTURE_PROJECTIONS[name])
            else:
                raise KeyError(f"unknown source table {name!r}")
        return self._tables[name]

    def _partsupp(self) -> DataFrame:
        if self.partsupp_mode == "lines":
            return (
                self.raw("lineitem")
                .select("l_partkey", "l_suppkey")
                .distinct()
                .selectExpr(
                    "l_partkey AS ps_partkey",
                    "l_suppkey AS ps_suppkey",
                    f"{PARTSUPP_LINES_AVAILQTY} AS ps_availqty",
                    f"{PARTSUPP_LINES_SUPPLYCOST} AS ps_supplycost",
                )
            )
        # The supplier count is a lazy scalar subquery, not a join: part rows
        # are expanded in place (a generator per row), no shuffle.
        n_suppliers = self.raw("supplier").select(F.count(F.lit(1))).scalar()
        slots = F.explode(F.array(*[F.lit(i) for i in range(PARTSUPP_FOUR_SUPPLIERS_PER_PART)]))
        return (
            self.raw("part")
            .select("p_partkey", slots.alias("i"))
            .withColumn("n", n_suppliers)
            .selectExpr(
                "p_partkey AS ps_partkey",
                f"{PARTSUPP_FOUR_SUPPKEY} AS ps_suppkey",
                f"{PARTSUPP_FOUR_AVAILQTY} AS ps_availqty",
                f"{PARTSUPP_FOUR_SUPPLYCOST} AS ps_supplycost",
            )
        )
