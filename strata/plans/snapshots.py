"""Time-stamped snapshots that are published by a commit record.

Layout, on any Hadoop filesystem (``file:``, ``hdfs:``, ``s3a:``)::

    {root}/{layer}/{table}/etl_inserted=<stamp>/attempt-<id>/part-*.parquet
    {root}/{layer}/{table}/_commits/<stamp>.<number>.json

A write goes to a folder of its own attempt, and nothing reads it until its
record is there.  The record is written last; it names the folder, the files
with their sizes, the rows and the schema.  Readers list records, never
folders, so what a crashed write left behind is not seen, and a stamp that is
written again keeps its earlier rows until the new record stands.  No data
file is ever renamed.  ``vacuum`` deletes the folders that no current record
names.

Reads take the schema of the snapshot they read, and check that its files are
those of the record.  The stamp is always a string; its type is never inferred.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans.hadoop_files import HadoopFiles
from strata.schemas import STAMP
from strata.session import release

# Characters that Spark escapes in partition directory names (fixed values), as far as stamps may hold them.
_ESCAPED = {c: f"%{ord(c):02X}" for c in "\"#%'*/:=?\\\x7f{[]^"} | {chr(i): f"%{i:02X}" for i in range(1, 32)}

COMMITS = "_commits"
# The codec of stored Parquet files, also in a session that was built elsewhere and writes with Spark's default.
COMPRESSION = "zstd"


class SnapshotNotFound(LookupError):
    """No published snapshot exists for the table."""


class SnapshotDamaged(RuntimeError):
    """The files of a published snapshot are not those of its record."""


@dataclass(frozen=True)
class Record:
    """A written attempt; published once it stands under ``_commits``."""

    layer: str
    name: str
    stamp: str
    path: str  # below the table's folder
    data_format: str
    schema: str  # JSON, without the stamp
    partition_keys: tuple[str, ...]  # besides the stamp
    rows: int
    files: tuple[tuple[str, int], ...]
    run: str = ""  # the run that wrote it

    @classmethod
    def from_json(cls, text: str) -> Record:
        raw = json.loads(text)
        return cls(**raw | {"partition_keys": tuple(raw["partition_keys"]), "files": tuple((n, s) for n, s in raw["files"])})


def escaped(stamp: str) -> str:
    return "".join(_ESCAPED.get(c, c) for c in stamp)


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str, data_format: str = "parquet", compression: str = COMPRESSION) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.data_format = data_format
        self.compression = compression
        self.files = HadoopFiles(spark)

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def partition_path(self, layer: str, name: str, stamp: str) -> str:
        """The folder of one stamp's attempts, named as Spark names partition directories."""
        return f"{self.path(layer, name)}/{STAMP}={escaped(stamp)}"

    # ------------------------------------------------------------ write, check, publish

    def stage(self, df: DataFrame, layer: str, name: str, stamp: str, data_format: str | None = None,
              max_records_per_file: int | None = None, partition_keys: Sequence[str] = (), run: str = "") -> Record:
        """Write ``df`` (without its stamp) aside, as a new attempt at the stamp; nobody reads it before ``publish``.

        The rows are written as the last step of ``df`` leaves them, with no
        shuffle for the write: adaptive execution merges small and splits
        skewed partitions of the table's own joins and groupings, and rows
        that lie side by side there pack well.  Rows are counted by the write
        itself.  Once they are written, Spark drops the shuffle files behind
        them.
        """
        fmt, rows = data_format or self.data_format, Observation(f"rows_{uuid.uuid4().hex}")
        below = f"{STAMP}={escaped(stamp)}/attempt-{uuid.uuid4().hex[:12]}"
        path, out = f"{self.path(layer, name)}/{below}", df.drop(STAMP)
        schema = out.schema
        counted = out.observe(rows, F.count(F.lit(1)).alias("rows"))
        writer = counted.write.format(fmt).mode("errorifexists")
        if fmt == "parquet":
            writer = writer.option("compression", self.compression)
        if partition_keys:
            writer = writer.partitionBy(*partition_keys)
        if max_records_per_file:
            writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
        try:
            writer.save(path)
        except PySparkException:
            self.files.delete(path)
            raise
        del counted, writer
        release(self.spark)
        return Record(layer, name, stamp, below, fmt, schema.json(), tuple(partition_keys), rows.get["rows"], tuple(self.files.data_files(path)), run)

    def staged(self, record: Record) -> DataFrame:
        """The rows of an attempt, published or not, from its own files and schema; no listing of other snapshots."""
        path = f"{self.path(record.layer, record.name)}/{record.path}"
        found = tuple(self.files.data_files(path))
        if found != record.files:
            lost = sorted(set(record.files) - set(found)) or sorted(set(found) - set(record.files))
            raise SnapshotDamaged(f"{path}: {len(record.files)} files were written, {len(found)} are there, first difference {lost[0][0]}")
        schema = T.StructType.fromJson(json.loads(record.schema))
        kept = [f for f in schema.fields if f.name not in record.partition_keys]
        typed = T.StructType(kept + [T.StructField(k, T.StringType(), True) for k in record.partition_keys])
        return self.spark.read.format(record.data_format).schema(typed).load(path).withColumn(STAMP, F.lit(record.stamp))

    def publish(self, record: Record) -> Record:
        """Make an attempt the snapshot of its stamp: one small new file, the last one written."""
        folder, text = f"{self.path(record.layer, record.name)}/{COMMITS}", json.dumps(asdict(record))
        number = max((n for s, n in self._commits(record.layer, record.name) if s == record.stamp), default=0) + 1
        while not self.files.write_new(f"{folder}/{escaped(record.stamp)}.{number:06d}.json", text):
            number += 1  # another run published the same stamp meanwhile
        return record

    def discard(self, record: Record) -> None:
        """Delete an attempt that is not to be published."""
        self.files.delete(f"{self.path(record.layer, record.name)}/{record.path}")

    def write_stamp(self, df: DataFrame, layer: str, name: str, stamp: str, data_format: str | None = None,
                    max_records_per_file: int | None = None) -> Record:
        """Write and publish ``df`` as the whole content of a stamp, also with no rows."""
        return self.publish(self.stage(df, layer, name, stamp, data_format, max_records_per_file))

    def write(self, df: DataFrame, layer: str, name: str,
              partition_keys: Sequence[str] = (STAMP,), data_format: str | None = None,
              max_records_per_file: int | None = None) -> str:
        """Write ``df`` partitioned by any columns; with the stamp among them, one published snapshot for each stamp in the data.

        Without the stamp the folder is a plain dataset, of which the
        partitions found in the data are replaced.
        """
        path, others = self.path(layer, name), [k for k in partition_keys if k != STAMP]
        if STAMP in partition_keys:
            for row in df.select(STAMP).distinct().orderBy(STAMP).collect():  # one row for each run in the data
                own = self.stage(df.where(F.col(STAMP) == row[0]), layer, name, row[0], data_format, max_records_per_file, others)
                self.publish(own)
            return path
        w = df.write.format(data_format or self.data_format).mode("overwrite")
        if partition_keys:
            w = w.partitionBy(*partition_keys).option("partitionOverwriteMode", "dynamic")
        if max_records_per_file:
            w = w.option("maxRecordsPerFile", str(max_records_per_file))
        w.save(path)
        return path

    def vacuum(self, layer: str, name: str) -> list[str]:
        """Delete the attempts that no current record names: those of failed and of superseded writes.  Not while a run writes the table."""
        current, base, gone = {self.record(layer, name, s).path for s in self.stamps(layer, name)}, self.path(layer, name), []
        for folder in self.files.names(base):
            if folder.startswith(f"{STAMP}="):
                for attempt in self.files.names(f"{base}/{folder}"):
                    if f"{folder}/{attempt}" not in current:
                        gone.append(f"{folder}/{attempt}")
                        self.files.delete(f"{base}/{gone[-1]}")
        return gone

    # ------------------------------------------------------------ read

    def _commits(self, layer: str, name: str) -> list[tuple[str, int]]:
        """(stamp, number) of every record: one listing, whatever the number of data files."""
        names = [n.rsplit(".", 2) for n in self.files.names(f"{self.path(layer, name)}/{COMMITS}") if n.endswith(".json") and not n.startswith(".")]
        return [(unquote(stamp), int(number)) for stamp, number, _ in names]

    def stamps(self, layer: str, name: str) -> list[str]:
        """All published ``etl_inserted`` values, oldest first."""
        return sorted({stamp for stamp, _ in self._commits(layer, name)})

    def record(self, layer: str, name: str, stamp: str) -> Record:
        """The latest record of a stamp."""
        number = max((n for s, n in self._commits(layer, name) if s == stamp), default=None)
        if number is None:
            raise SnapshotNotFound(f"no snapshot of {stamp} under {self.path(layer, name)}")
        return Record.from_json(self.files.read_text(f"{self.path(layer, name)}/{COMMITS}/{escaped(stamp)}.{number:06d}.json"))

    def latest_stamp(self, layer: str, name: str) -> str:
        """The greatest published ``etl_inserted`` value."""
        found = self.stamps(layer, name)
        if not found:
            raise SnapshotNotFound(f"no snapshot found under {self.path(layer, name)}")
        return found[-1]

    def read_latest(self, layer: str, name: str) -> DataFrame:
        """Rows of the most recent snapshot, with the columns of that snapshot."""
        return self.staged(self.record(layer, name, self.latest_stamp(layer, name)))

    def read_partition(self, layer: str, name: str, partition_values: Mapping[str, str]) -> DataFrame:
        """Rows of the named partition(s): one equality filter per entry, any number of keys.

        The stamp picks the snapshot; without it the filters go over all
        published snapshots.
        """
        wanted = dict(partition_values)
        stamps = [str(wanted.pop(STAMP))] if STAMP in wanted else self.stamps(layer, name)
        if not stamps:
            raise SnapshotNotFound(f"no snapshot found under {self.path(layer, name)}")
        df = reduce(DataFrame.unionByName, [self.staged(self.record(layer, name, s)) for s in stamps])
        for k, v in wanted.items():
            df = df.where(F.col(k) == F.lit(str(v)))
        return df
