"""Check suites from a JSON file, compiled to few passes over a stored table.

A suite maps table names to lists of checks::

    {"fct_orders": [{"check": "not_null", "column": "order_key"},
                    {"check": "unique", "columns": ["order_key", "line_number"]},
                    {"check": "foreign_key", "columns": ["customer_key"], "table": "dim_customer", "references": ["customer_key"]}]}

Kinds: ``not_null``, ``in_set`` (values), ``between`` (min, max, either may be
left out), ``matches`` (pattern, anywhere in the text), ``satisfies`` (a SQL
expression), ``row_count`` (min, max), ``unique`` and ``foreign_key``.  A NULL
passes ``in_set``, ``between`` and ``matches`` (ask for ``not_null`` too) and
fails ``satisfies``; keys with a NULL are neither duplicates nor orphans.  Any
check may have a ``name``, and ``allow``: failed rows up to which it passes.

All row checks of a table are one aggregate over one scan; unique keys are
folded per key, foreign keys by ``strata.operators.references``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.references import Reference, orphan_counts

# Kinds of checks, and the arguments each must have (first) and may have (second).
KINDS: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    "not_null": (frozenset({"column"}), frozenset()),
    "in_set": (frozenset({"column", "values"}), frozenset()),
    "between": (frozenset({"column"}), frozenset({"min", "max"})),
    "matches": (frozenset({"column", "pattern"}), frozenset()),
    "satisfies": (frozenset({"expression"}), frozenset()),
    "row_count": (frozenset(), frozenset({"min", "max"})),
    "unique": (frozenset({"columns"}), frozenset()),
    "foreign_key": (frozenset({"columns", "table", "references"}), frozenset()),
}
REPORT = ("table_name", "check_name", "checked_rows", "failed_rows", "allowed_rows")


class SuiteError(ValueError):
    """A suite that cannot be compiled; says where."""


@dataclass(frozen=True)
class Check:
    kind: str
    args: Mapping[str, Any] = field(hash=False)
    name: str = ""
    allow: int = 0


def parse_suite(text: str) -> dict[str, tuple[Check, ...]]:
    """The checks of each table.  Raises ``SuiteError`` on unknown kinds, missing or unknown arguments and repeated names."""
    raw = json.loads(text)
    if not isinstance(raw, dict) or not all(isinstance(v, list) for v in raw.values()):
        raise SuiteError("a suite is an object of lists, by table name")
    out = {}
    for table, entries in raw.items():
        checks = []
        for number, entry in enumerate(entries, 1):
            where = f"{table}, check {number}"
            if not isinstance(entry, dict) or entry.get("check") not in KINDS:
                raise SuiteError(f"{where}: 'check' must be one of {', '.join(KINDS)}")
            kind, args = entry["check"], {k: v for k, v in entry.items() if k not in ("check", "name", "allow")}
            needed, possible = KINDS[kind]
            if needed - set(args) or set(args) - needed - possible:
                raise SuiteError(f"{where}: {kind} takes {sorted(needed | possible)}, and needs {sorted(needed)}, not {sorted(args)}")
            if kind == "foreign_key" and len(args["columns"]) != len(args["references"]):
                raise SuiteError(f"{where}: as many references as columns are needed")
            checks.append(Check(kind, args, entry.get("name") or _name(kind, args), int(entry.get("allow", 0))))
        repeated = {c.name for c in checks if sum(c.name == d.name for d in checks) > 1}
        if repeated:
            raise SuiteError(f"{table}: checks of one name: {', '.join(sorted(repeated))}")
        out[table] = tuple(checks)
    return out


def load_suite(path: str) -> dict[str, tuple[Check, ...]]:
    with open(path, encoding="utf-8") as f:
        return parse_suite(f.read())


def _name(kind: str, args: Mapping[str, Any]) -> str:
    of = args.get("column") or args.get("columns") or args.get("expression") or ""
    own = f"{kind}({', '.join(of) if isinstance(of, list) else of})"
    return f"{own} -> {args['table']}" if kind == "foreign_key" else own


def spec_checks(keys: Sequence[str], unique: bool, rules: Mapping[str, str]) -> tuple[Check, ...]:
    """What a table's declaration asks for: keys never NULL, unique where declared so, and its rules."""
    out = [Check("not_null", {"column": k}, f"not_null({k})") for k in keys]
    if unique and keys:
        out.append(Check("unique", {"columns": list(keys)}, f"unique({', '.join(keys)})"))
    return (*out, *[Check("satisfies", {"expression": e}, n) for n, e in rules.items()])


def _row_passes(check: Check) -> Column:
    args = check.args
    if check.kind == "satisfies":
        return F.coalesce(F.expr(args["expression"]), F.lit(False))
    value = F.col(args["column"])
    if check.kind == "not_null":
        return value.isNotNull()
    if check.kind == "in_set":
        return F.coalesce(value.isin(list(args["values"])), F.lit(True))
    if check.kind == "matches":
        return F.coalesce(value.rlike(args["pattern"]), F.lit(True))
    bounds = [value >= F.lit(args["min"])] if "min" in args else []
    bounds += [value <= F.lit(args["max"])] if "max" in args else []
    return F.coalesce(reduce(Column.__and__, bounds, F.lit(True)), F.lit(True))


def _report(table: str, checks: Sequence[Check], counts: DataFrame) -> DataFrame:
    """``counts`` (checked_rows, f0, f1, ...: failed rows of each check) as report rows."""
    rows = F.explode(F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.col(f"f{i}").cast("bigint").alias("failed_rows"), F.lit(c.allow).cast("bigint").alias("allowed_rows"))
                               for i, c in enumerate(checks)])).alias("r")
    return counts.select("checked_rows", rows).select(F.lit(table).alias("table_name"), "r.check_name", "checked_rows", "r.failed_rows", "r.allowed_rows")


def _row_report(table: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One aggregate over one scan.  A row count out of bounds fails by the rows that are too many or too few."""
    total = F.count(F.lit(1))
    counts = []
    for i, c in enumerate(checks):
        if c.kind == "row_count":
            over = total - F.lit(c.args["max"]) if "max" in c.args else F.lit(0)
            under = F.lit(c.args["min"]) - total if "min" in c.args else F.lit(0)
            counts.append(F.greatest(over, under, F.lit(0)).alias(f"f{i}"))
        else:
            counts.append(F.count(F.when(~_row_passes(c), F.lit(1))).alias(f"f{i}"))
    return _report(table, checks, df.agg(total.alias("checked_rows"), *counts))


def _unique_report(table: str, df: DataFrame, check: Check) -> DataFrame:
    """Rows too many of a key; folded per key before the shuffle, so a hot key is one row of each task."""
    keys = check.args["columns"]
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    zero = F.lit(0).cast("bigint")
    return _report(table, [check], per_key.agg(F.coalesce(F.sum("n"), zero).alias("checked_rows"), F.coalesce(F.sum(F.when(whole, F.col("n") - 1)), zero).alias("f0")))


def suite_report(table: str, df: DataFrame, checks: Sequence[Check], tables: Callable[[str], DataFrame] | None = None) -> DataFrame | None:
    """(table_name, check_name, checked_rows, failed_rows, allowed_rows) of a table's checks; ``tables`` gives the parents of foreign keys."""
    parts, by_row = [], [c for c in checks if c.kind not in ("unique", "foreign_key")]
    if by_row:
        parts.append(_row_report(table, df, by_row))
    parts += [_unique_report(table, df, c) for c in checks if c.kind == "unique"]
    foreign = [c for c in checks if c.kind == "foreign_key"]
    if foreign:
        references = [Reference(tuple(c.args["columns"]), c.args["table"], tuple(c.args["references"])) for c in foreign]
        counts = orphan_counts(table, df, references, [tables(r.parent) for r in references])
        named = F.element_at(F.create_map(*[F.lit(x) for r, c in zip(references, foreign) for x in (r.name, c.name)]), F.col("reference"))
        allowed = F.element_at(F.create_map(*[F.lit(x) for r, c in zip(references, foreign) for x in (r.name, str(c.allow))]), F.col("reference"))
        parts.append(counts.select("table_name", named.alias("check_name"), "checked_rows", F.col("orphan_rows").alias("failed_rows"), allowed.cast("bigint").alias("allowed_rows")))
    return reduce(DataFrame.unionByName, parts) if parts else None


def violations(report: DataFrame | None) -> list[str]:
    """What failed beyond what is allowed, one line each; a report has a row per check."""
    failed = [] if report is None else report.where(F.col("failed_rows") > F.col("allowed_rows")).orderBy("check_name").collect()
    return [f"{r.check_name} failed on {r.failed_rows} of {r.checked_rows} rows" for r in failed]
