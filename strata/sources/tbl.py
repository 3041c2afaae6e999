"""Delimited-text (``.tbl``) source: the TPC-H dbgen output format.

Each line is ``|``-separated with one trailing ``|``; an empty field is NULL;
there is no header.  Spark's CSV reader splits files across tasks, so large
``.tbl`` files load in parallel.  The trailing delimiter yields one extra,
always-empty column which is dropped.

A line that does not fit the schema is rejected: it is left out of the rows
and goes to a side table with its file, the offset of the split that holds it
and the reason.  Rejects are counted by the job that reads the rows, so a
clean load is one pass; the side table is written only if there are any.  A
load with more rejects than its limit fails.  A read of some columns checks the
types of those columns only; a load into bronze reads all.  A missing file is an error
unless the source is told to take it for an empty table.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.schemas import SOURCE_SCHEMAS

log = logging.getLogger(__name__)

TRAILING, BROKEN = "_trailing", "_broken"
REJECT_COLUMNS = ("file", "split_offset", "line", "reason")


class RejectedLines(ValueError):
    """A load had more lines that do not fit the schema than its limit."""


def parse_tbl(spark: SparkSession, path: str, schema: T.StructType, allow_missing: bool = False) -> DataFrame | None:
    """All lines with ``schema``'s columns, and the whole line in ``BROKEN`` where it does not fit; None for an allowed missing file."""
    wide = T.StructType([*schema.fields, T.StructField(TRAILING, T.StringType()), T.StructField(BROKEN, T.StringType())])
    reader = (
        spark.read.schema(wide)
        .option("sep", "|")
        .option("header", "false")
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("quote", "\u0000")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BROKEN)
        .option("columnPruning", "false")  # a line's fields are counted whatever columns are asked for
        .option("dateFormat", "yyyy-MM-dd")
    )
    try:
        return reader.csv(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e.getCondition() or e):
            raise
        if not allow_missing:
            raise FileNotFoundError(path) from e
        log.warning("%s does not exist; loading an empty table", path)
        return None


def _fits() -> Column:
    """Whether a line has all fields, each of its type, and nothing after its last delimiter."""
    return F.col(BROKEN).isNull() & F.col(TRAILING).isNull()


def _line(schema: T.StructType) -> Column:
    """The text of a line that does not fit; one that only goes on after its last delimiter is put together from its fields."""
    fields = [F.coalesce(F.col(f.name).cast("string"), F.lit("")) for f in schema.fields]
    return F.coalesce(F.col(BROKEN), F.concat_ws("|", *fields, F.col(TRAILING)))


def _reason(schema: T.StructType) -> Column:
    """Why a line does not fit: its number of fields, or the first field that is not of its type."""
    fields = F.split(F.col(BROKEN), r"\|", -1)
    n, wanted = F.size(fields), len(schema.fields) + 1
    out = F.when(F.col(BROKEN).isNull(), F.concat(F.lit("text after the last delimiter: "), F.col(TRAILING)))
    out = out.when(n != wanted, F.concat(n.cast("string"), F.lit(f" fields, not {wanted}")))
    for i, f in enumerate(schema.fields):
        value = F.get(fields, F.lit(i))
        if not isinstance(f.dataType, T.StringType):
            out = out.when((value != "") & value.try_cast(f.dataType).isNull(), F.concat(F.lit(f"{f.name} is not {f.dataType.simpleString()}: "), value))
    return out.otherwise(F.lit("unreadable"))


def rejected_lines(parsed: DataFrame, schema: T.StructType) -> DataFrame:
    """The side table: ``REJECT_COLUMNS`` of every line that does not fit."""
    meta = parsed.metadataColumn("_metadata")
    return parsed.select("*", meta["file_path"].alias("_file"), meta["file_block_start"].alias("_offset")).where(~_fits()).select(
        F.col("_file").alias("file"), F.col("_offset").alias("split_offset"), _line(schema).alias("line"), _reason(schema).alias("reason"))


def _fitting(parsed: DataFrame) -> DataFrame:
    return parsed.where(_fits()).drop(TRAILING, BROKEN)


def read_tbl(spark: SparkSession, path: str, schema: T.StructType, allow_missing: bool = False) -> DataFrame:
    """Load one ``.tbl`` file (or directory of part files) with ``schema``; any line that does not fit fails the job that reads it."""
    parsed = parse_tbl(spark, path, schema, allow_missing)
    if parsed is None:
        return spark.createDataFrame([], schema)
    fits = F.when(_fits(), True).otherwise(F.raise_error(F.concat(F.lit("line does not fit: "), _reason(schema), F.lit(" in "), _line(schema))).cast("boolean"))
    return _fitting(parsed.where(fits))


def write_tbl(df: DataFrame, path: str) -> None:
    """Write ``df`` in ``.tbl`` form: ``|``-joined fields, trailing ``|``, NULL as empty."""
    df.select(tbl_line(df.columns).alias("value")).write.mode("overwrite").text(path)


def tbl_line(columns: list[str]) -> Column:
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.concat(F.concat_ws("|", *fields), F.lit("|"))


class TblSource:
    """Source reading ``{directory}/{table}.tbl*`` with the TPC-H DDL schema.

    The pattern takes a single file, the numbered chunks dbgen writes for
    large scale factors (``lineitem.tbl.1`` ... ``lineitem.tbl.N``), a
    directory of part files, and compressed text (``.tbl.gz``); all of them
    are read by one parallel CSV scan.

    Lines that do not fit are left out.  Whoever has written a table calls
    ``settle``, which looks at the count that the write itself has made: more
    than ``max_rejects`` raise ``RejectedLines``, fewer go to
    ``{reject_dir}/{table}``.
    """

    name = "tbl"

    def __init__(self, spark: SparkSession, directory: str, schemas: dict[str, T.StructType] | None = None, max_rejects: int = 0,
                 reject_dir: str | None = None, allow_missing: bool = False) -> None:
        self.spark = spark
        self.directory = directory.rstrip("/")
        self.schemas = schemas or SOURCE_SCHEMAS
        self.max_rejects, self.reject_dir, self.allow_missing = max_rejects, reject_dir and reject_dir.rstrip("/"), allow_missing
        self._counts: dict[str, Observation] = {}

    def _parsed(self, name: str) -> DataFrame | None:
        if name not in self.schemas:
            raise KeyError(f"unknown source table {name!r}")
        return parse_tbl(self.spark, f"{self.directory}/{name}.tbl*", self.schemas[name], self.allow_missing)

    def table(self, name: str) -> DataFrame:
        """The lines of a table that fit; its rejects are counted by the first job over it."""
        parsed = self._parsed(name)
        if parsed is None:
            return self.spark.createDataFrame([], self.schemas[name])
        self._counts[name] = Observation(f"rejects_{name}_{uuid.uuid4().hex[:8]}")
        return _fitting(parsed.observe(self._counts[name], F.count(F.when(~_fits(), 1)).alias("rejects")))

    def rejects(self, name: str) -> DataFrame:
        """The lines of a table that do not fit, with file, offset and reason."""
        parsed = self._parsed(name)
        if parsed is None:
            return self.spark.createDataFrame([], "file string, split_offset bigint, line string, reason string")
        return rejected_lines(parsed, self.schemas[name])

    def settle(self, name: str) -> int:
        """Lines rejected by the job that has just read the table; stores them, or raises if they are too many."""
        found = self._counts.pop(name).get["rejects"] if name in self._counts else 0
        if found > self.max_rejects:
            first = "; ".join(f"{r.reason} ({r.file})" for r in self.rejects(name).limit(3).collect())
            raise RejectedLines(f"{name}: {found} lines do not fit, {self.max_rejects} may: {first}")
        if found and self.reject_dir:
            self.rejects(name).write.mode("overwrite").parquet(f"{self.reject_dir}/{name}")
        if found:
            log.warning("%s: %d lines do not fit", name, found)
        return found
