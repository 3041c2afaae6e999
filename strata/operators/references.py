"""Referential checks: rows whose key columns name no row of the parent table.

All references of a child table are checked in one scan of its key columns.
The keys are folded to (reference, key, rows) inside each task before anything
is shuffled, so what travels is one row for each distinct key of a task, never
the child's rows, and a key that a third of the rows share is one row.  Counts
are exact.  (A Bloom filter of the parents could prove orphans without any
shuffle, but not their absence: orphans among its false positives would be
missed.)

As in SQL, a row with a NULL in the key columns refers to nothing and is no
orphan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMNS = ("table_name", "reference", "checked_rows", "orphan_rows", "orphan_keys")


@dataclass(frozen=True)
class Reference:
    """Columns of a child table that name the row of a parent with the same values in ``parent_columns``."""

    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"{', '.join(self.columns)} -> {self.parent}"


def _kinds(child: DataFrame, parents: Sequence[DataFrame], references: Sequence[Reference]) -> list[str]:
    """The type of each key position that all references can be compared in."""
    width = max(len(r.columns) for r in references)
    whole = [True] * width
    for r, parent in zip(references, parents):
        for i, (c, p) in enumerate(zip(r.columns, r.parent_columns)):
            whole[i] &= isinstance(child.schema[c].dataType, T.IntegralType) and isinstance(parent.schema[p].dataType, T.IntegralType)
    return ["bigint" if w else "string" for w in whole]


def _keys(number: int, columns: Sequence[str], kinds: Sequence[str]) -> list[Column]:
    """The reference's number and its key; positions it does not use hold a constant."""
    used = [F.col(c).cast(k).alias(f"k{i}") for i, (c, k) in enumerate(zip(columns, kinds))]
    return [F.lit(number).alias("ref"), *used, *[F.lit(0).cast(k).alias(f"k{i}") for i, k in enumerate(kinds) if i >= len(columns)]]


def orphan_counts(name: str, child: DataFrame, references: Sequence[Reference], parents: Sequence[DataFrame]) -> DataFrame:
    """One row per reference: rows checked, rows that refer to no parent, and their distinct keys."""
    kinds = _kinds(child, parents, references)
    on = ["ref", *[f"k{i}" for i in range(len(kinds))]]
    entries = F.explode(F.array(*[F.struct(*_keys(i, r.columns, kinds)) for i, r in enumerate(references)])).alias("e")
    folded = child.select(entries).select("e.*").groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    known = reduce(DataFrame.unionByName, [p.select(*_keys(i, r.parent_columns, kinds)) for i, (r, p) in enumerate(zip(references, parents))])
    known = known.groupBy(*on).agg(F.lit(True).alias("known"))
    orphan = reduce(Column.__and__, [F.col(k).isNotNull() for k in on]) & F.col("known").isNull()
    counts = folded.join(known, on, "left").groupBy("ref").agg(
        F.sum("n").alias("checked_rows"), F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0).cast("bigint")).alias("orphan_rows"), F.count(F.when(orphan, 1)).alias("orphan_keys"))
    # A child without rows still has its references.
    names = child.sparkSession.createDataFrame([(i, r.name) for i, r in enumerate(references)], "ref int, reference string")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
    return names.join(counts, "ref", "left").select(F.lit(name).alias("table_name"), "reference", *[zero(c) for c in COLUMNS[2:]])
