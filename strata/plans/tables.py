"""Table specifications: the 14 tables of the pipeline as data.

A spec names its layer, declared key, upstream tables and a ``build``
function from upstream DataFrames to its own (lazy) DataFrame.  The run
graph (``strata.plans.pipeline``) walks these specs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame

from strata.operators import bronze as B
from strata.operators import gold as G
from strata.operators import silver as S
from strata.schemas import SOURCE_KEYS, SOURCE_TABLES, STAMP

if TYPE_CHECKING:
    from strata.plans.pipeline import RunContext

Build = Callable[["RunContext", Mapping[str, DataFrame]], DataFrame]


@dataclass(frozen=True)
class TableSpec:
    name: str
    layer: str
    keys: tuple[str, ...]
    upstream: tuple[str, ...]
    build: Build
    partition_keys: tuple[str, ...] = (STAMP,)
    data_format: str = "parquet"
    rules: Mapping[str, str] = field(default_factory=dict)
    # Whether validation blocks on duplicates of ``keys``; declared keys that the design repeats are only reported.
    unique: bool = True
    doc: str = field(default="", compare=False)


# Column rules checked by validation: name -> SQL boolean every row must satisfy
# (a NULL result fails).
RULES: dict[str, dict[str, str]] = {
    "dim_customer": {
        "segment_present": "market_segment IS NOT NULL",
        "nation_resolved": "nation_name IS NOT NULL",
    },
    "dim_part": {
        "retail_price_positive": "retail_price > 0",
    },
    "fct_orders": {
        "quantity_non_negative": "quantity >= 0",
        "discount_in_range": "discount_percentage BETWEEN 0 AND 1",
        "tax_non_negative": "tax_percentage >= 0",
        "status_known": "order_status IN ('F', 'O', 'P')",
        "net_amount_present": "net_amount IS NOT NULL",
    },
    "finance_metrics": {
        "orders_counted": "order_count > 0",
        "revenue_non_negative": "total_revenue >= 0",
    },
    "marketing_metrics": {
        "late_rate_in_range": "late_delivery_rate BETWEEN 0 AND 100",
    },
}


def _bronze_spec(table: str) -> TableSpec:
    return TableSpec(
        name=table,
        layer="bronze",
        keys=SOURCE_KEYS[table],
        upstream=(),
        build=lambda ctx, _up, t=table: B.bronze(ctx.source.table(t), ctx.run_ts),
        doc=f"source table {table} stamped with the run",
    )


def _dim_customer(ctx: RunContext, up: Mapping[str, DataFrame]) -> DataFrame:
    return S.dim_customer(up["customer"], up["nation"], up["region"], ctx.run_ts)


def _dim_part(ctx: RunContext, up: Mapping[str, DataFrame]) -> DataFrame:
    return S.dim_part(up["part"], up["partsupp"], up["supplier"], up["nation"], up["region"], ctx.run_ts,
                      with_supplier_key=ctx.part_match == "part_supplier")


def _fct_orders(ctx: RunContext, up: Mapping[str, DataFrame]) -> DataFrame:
    return S.fct_orders(up["orders"], up["lineitem"], ctx.run_ts)


def _wide(ctx: RunContext, up: Mapping[str, DataFrame]) -> DataFrame:
    return G.wide_order_details(up["fct_orders"], up["dim_customer"], up["dim_part"], ctx.run_ts, ctx.part_match)


def _mart_input(ctx: RunContext, up: Mapping[str, DataFrame]) -> DataFrame:
    if "wide_order_details" in up:
        return up["wide_order_details"]
    if "lineitem" in up:
        return G.mart_lines_from_sources(up["orders"], up["lineitem"], up["dim_customer"], up["dim_part"], ctx.part_match)
    return G.mart_lines(up["fct_orders"], up["dim_customer"], up["dim_part"], ctx.part_match)


def _finance(ctx: RunContext, up: Mapping[str, DataFrame]) -> DataFrame:
    return G.finance_metrics(_mart_input(ctx, up), ctx.run_ts, ctx.as_of)


def _marketing(ctx: RunContext, up: Mapping[str, DataFrame]) -> DataFrame:
    return G.marketing_metrics(_mart_input(ctx, up), ctx.run_ts)


SILVER_INPUTS = ("fct_orders", "dim_customer", "dim_part")
# What the marts read, by ``mart_input``.
MART_INPUTS = {"silver": SILVER_INPUTS, "wide": ("wide_order_details",), "source": ("orders", "lineitem", "dim_customer", "dim_part")}


def table_specs(mart_input: str = "silver") -> dict[str, TableSpec]:
    """All 14 specs.  ``mart_input="wide"`` makes the marts read the wide
    table (the original plan); ``"silver"`` feeds them from the silver tables
    with fan-out weights, ``"source"`` from the source lines and orders with
    the same weights and one shuffle of the lines fewer (same results, no
    fanned-out rows)."""
    if mart_input not in MART_INPUTS:
        raise ValueError(f"mart_input must be one of {sorted(MART_INPUTS)}, got {mart_input!r}")
    mart_up = MART_INPUTS[mart_input]
    specs = [_bronze_spec(t) for t in SOURCE_TABLES]
    specs += [
        TableSpec("dim_customer", "silver", ("customer_key",), ("customer", "nation", "region"), _dim_customer),
        TableSpec("dim_part", "silver", ("part_key",), ("part", "partsupp", "supplier", "nation", "region"), _dim_part, unique=False),
        TableSpec("fct_orders", "silver", ("order_key", "line_number"), ("orders", "lineitem"), _fct_orders),
        TableSpec("wide_order_details", "gold", ("order_key", "line_number"), SILVER_INPUTS, _wide, unique=False),
        TableSpec("finance_metrics", "gold", ("dt", "customer_nation", "customer_region"), mart_up, _finance),
        TableSpec("marketing_metrics", "gold", ("month", "market_segment"), mart_up, _marketing),
    ]
    return {s.name: (replace(s, rules=RULES[s.name]) if s.name in RULES else s) for s in specs}
