"""Dataset validation: row counts, NULL keys and duplicate keys.

Each table is checked with one aggregation (``groupBy(keys).count()``,
partially aggregated before the shuffle, so a hot key costs one row per
task).  The per-table summaries are unioned into one report.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_COLUMNS = ("table_name", "row_count", "null_key_rows", "duplicate_key_values", "duplicate_rows")


class InvalidDataError(ValueError):
    """A dataset failed validation; nothing was published."""


def key_summary(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: total rows, rows with a NULL key part, duplicated key values and surplus rows."""
    if not keys:
        return df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.lit(0).cast("bigint").alias("null_key_rows"),
            F.lit(0).cast("bigint").alias("duplicate_key_values"),
            F.lit(0).cast("bigint").alias("duplicate_rows"),
        )
    any_null = None
    for k in keys:
        e = F.col(k).isNull()
        any_null = e if any_null is None else any_null | e
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    dup = (~any_null) & (F.col("_n") > 1)
    zero = F.lit(0).cast("bigint")
    return per_key.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("_n"), zero).alias("row_count"),
        F.coalesce(F.sum(F.when(any_null, F.col("_n"))), zero).alias("null_key_rows"),
        F.count(F.when(dup, F.lit(1))).alias("duplicate_key_values"),
        F.coalesce(F.sum(F.when(dup, F.col("_n") - 1)), zero).alias("duplicate_rows"),
    )


def key_report(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Union of ``key_summary`` over ``{name: (frame, keys)}``."""
    parts = [key_summary(name, df, keys) for name, (df, keys) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


RULE_COLUMNS = ("table_name", "rule", "checked_rows", "failed_rows")


def rule_summary(name: str, df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row per rule: rows checked and rows failing it, from a single aggregation.

    A rule is a SQL boolean expression every row must satisfy; a row fails
    when the expression is false or NULL.
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, expr in enumerate(rules.values()):
        aggs.append(F.count(F.when(~F.coalesce(F.expr(expr), F.lit(False)), F.lit(1))).alias(f"_r{i}"))
    counts = df.agg(*aggs)
    stack = ", ".join(f"'{r}', _r{i}" for i, r in enumerate(rules))
    return counts.selectExpr(
        f"'{name}' AS table_name", f"stack({len(rules)}, {stack}) AS (rule, failed_rows)", "_rows AS checked_rows"
    ).select(*RULE_COLUMNS)


def rule_report(tables: Mapping[str, tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Union of ``rule_summary`` over ``{name: (frame, rules)}`` (tables without rules skipped)."""
    parts = [rule_summary(n, df, rules) for n, (df, rules) in tables.items() if rules]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def validate(name: str, df: DataFrame, keys: Sequence[str], rules: Mapping[str, str] | None = None) -> dict:
    """Raise ``InvalidDataError`` on NULL or duplicate keys or failed rules; else return the summary.

    Two small aggregation jobs: the key summary, then all rule counts in one pass.
    """
    row = key_summary(name, df, keys).first().asDict()
    problems = []
    if row["null_key_rows"] or row["duplicate_key_values"]:
        problems.append(f"{row['null_key_rows']} rows with NULL key, "
                        f"{row['duplicate_key_values']} duplicated key values on {list(keys)}")
    if rules:
        failed = {r.rule: r.failed_rows for r in rule_summary(name, df, rules).collect() if r.failed_rows}
        row["failed_rules"] = failed
        problems += [f"rule {k!r} failed on {v} rows" for k, v in failed.items()]
    if problems:
        raise InvalidDataError(f"{name}: " + "; ".join(problems))
    return row
