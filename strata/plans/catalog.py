"""Catalog tables: persistent names for published snapshots and dashboards, and co-partitioned (bucketed) storage.

A published snapshot becomes an external table over its own files, and a
persistent view under the table's name adds the stamp.  Publishing a later
stamp replaces the view, so a reader by name sees one snapshot or the other.
Dashboards are persistent views over those.  With a Hive metastore the names
outlive the application; with Spark's own catalog they last as long as it.

Bucketed tables are dealt by a key once, when they are written.  Joins and
groupings by that key read them without a shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.plans.snapshots import Record, SnapshotStore
from strata.schemas import STAMP


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Catalog:
    def __init__(self, spark: SparkSession, database: str, location: str | None = None) -> None:
        """Names go to ``database``, which is made if it is missing (at ``location``, a folder on the shared storage)."""
        self.spark, self.database = spark, database
        at = f" LOCATION {_text(location)}" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}{at}")

    def name(self, table: str) -> str:
        return f"{_quoted(self.database)}.{_quoted(table)}"

    # ------------------------------------------------------------ published snapshots

    def publish_snapshot(self, store: SnapshotStore, record: Record) -> str:
        """Make ``record`` what the table's name stands for; the files stay where they are.  Returns the full name."""
        if record.partition_keys:
            raise ValueError(f"{record.name}: snapshots partitioned by more than the stamp have no catalog table")
        files = f"{record.name}__{record.path.rpartition('-')[2]}"
        if not self.spark.catalog.tableExists(f"{self.database}.{files}"):
            self.spark.catalog.createTable(f"{self.database}.{files}", path=f"{store.path(record.layer, record.name)}/{record.path}", source=record.data_format,
                                           schema=T.StructType.fromJson(json.loads(record.schema)))
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(record.name)} AS SELECT *, {_text(record.stamp)} AS {STAMP} FROM {self.name(files)}")
        earlier = [t.name for t in self.spark.catalog.listTables(self.database) if not t.isTemporary and t.name.startswith(f"{record.name}__") and t.name != files]
        for table in earlier:  # external: their files stay
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
        return f"{self.database}.{record.name}"

    def publish_latest(self, store: SnapshotStore, tables: Mapping[str, str]) -> list[str]:
        """``publish_snapshot`` of the latest published stamp of each table, given as {name: layer}."""
        return [self.publish_snapshot(store, store.record(layer, name, store.latest_stamp(layer, name))) for name, layer in tables.items()]

    def publish_view(self, view: str, table: str, labels: Sequence[tuple[str, str]]) -> str:
        """A persistent view of a table's columns under display labels."""
        columns = ", ".join(f"{_quoted(column)} AS {_quoted(label)}" for column, label in labels)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(view)} AS SELECT {columns} FROM {self.name(table)}")
        return f"{self.database}.{view}"

    # ------------------------------------------------------------ co-partitioned storage

    def write_bucketed(self, df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str) -> DataFrame:
        """Write ``df`` dealt and sorted by ``keys``, one file per bucket, and return the table.

        One shuffle and one sort (the writer's own), now; joins by the same
        keys of tables with the same number of buckets need no shuffle later.
        A task holds a bucket while it sorts it, so their number has to grow
        with the table.
        """
        (df.repartition(buckets, *keys).write.format("parquet").mode("errorifexists").option("path", path)
         .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(f"{self.database}.{table}"))
        return self.spark.table(f"{self.database}.{table}")
