"""Parquet source: TPC-H tables stored as Parquet (``{dir}/{table}.parquet``
or a ``{dir}/{table}`` directory), cast to the DDL types.

Only the columns present in the files are returned; each is cast to its
DDL type, so money becomes ``decimal(15,2)`` and dates ``date`` whatever the
writer used.  Casts are plain projections: filters and column pruning still
reach the scan.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.schemas import SOURCE_SCHEMAS


class ParquetSource:
    name = "parquet"

    def __init__(self, spark: SparkSession, directory: str, schemas: dict[str, T.StructType] | None = None) -> None:
        self.spark = spark
        self.directory = directory.rstrip("/")
        self.schemas = schemas or SOURCE_SCHEMAS

    def table(self, name: str) -> DataFrame:
        try:
            df = self.spark.read.parquet(f"{self.directory}/{name}.parquet")
        except AnalysisException:
            df = self.spark.read.parquet(f"{self.directory}/{name}")
        ddl = {f.name: f.dataType for f in self.schemas.get(name, T.StructType()).fields}
        return df.select(*[F.col(c).cast(ddl[c]).alias(c) if c in ddl else F.col(c) for c in df.columns])
