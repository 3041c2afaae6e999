"""Shared helpers: scratch tables on the cluster's shared storage, row ids, and byte-level word spans for Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import release

# Bytes handled at once inside a task: bounds the temporary arrays of the vectorised passes.
SLICE_BYTES = 1 << 20


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, read from the session.

    Only a local session may leave it unset (as in tests); there the operator
    library's own default for local sessions applies.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    from strata.session import shared_dir

    return shared_dir(spark).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under this application's scratch folder on the shared storage."""
    return f"{shared_root(spark)}/strata-llm/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet on the shared storage and read it back: cuts the lineage, survives lost executors."""
    return Scratch(df.sparkSession).stage(df, label)


class Scratch:
    """Written intermediate tables that go at the end of a ``with`` block, when nothing reads them any more.

    What a table was built with is of no use once it is written, so each write
    also lets Spark drop the shuffle files behind it: the cleaner waits for
    the JVM to collect the plans, which a driver with little to do may not do
    for half an hour.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        for path in self.paths:
            _delete(self.spark, path)
        release(self.spark)

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        path, schema = scratch_path(self.spark, label), df.schema
        df.write.parquet(path)
        self.paths.append(path)
        del df
        release(self.spark)
        return self.spark.read.schema(schema).parquet(path)


def stored_bytes(table: DataFrame) -> int:
    """The size of a written table's files."""
    context = table.sparkSession.sparkContext
    size = 0
    for name in table.inputFiles():
        where = context._jvm.org.apache.hadoop.fs.Path(name)
        size += where.getFileSystem(context._jsc.hadoopConfiguration()).getFileStatus(where).getLen()
    return size


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete every scratch table this application wrote.  Call it once the results built on them are stored."""
    _delete(spark, f"{shared_root(spark)}/strata-llm/{spark.sparkContext.applicationId}")


def fresh(columns: list[str], *names: str) -> list[str]:
    """Names derived from ``names`` that clash with none of ``columns`` (Spark compares names without case)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """Add a row id, unique per row, so that repeated rows and null ids stay apart; stage the result before using it twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


# Plan nodes that pass a file's rows on one for one.
_ONE_FOR_ONE = {"Project", "Filter", "SubqueryAlias"}


def _of_files(df: DataFrame) -> bool:
    plan = df._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in _ONE_FOR_ONE:
        plan = plan.children().apply(0)
    return plan.getClass().getSimpleName() == "LogicalRelation"


def placed(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a row id that is the same whenever the plan runs, whatever the splits, the cores or the executors.

    A row of a Parquet table is named by its file and its place in that file,
    which no split changes; the leading bits are a hash of the file's path
    under which the table's files are all different.  Any other frame is
    numbered once, written, and read back with its numbers.
    """
    try:
        if not _of_files(df):
            raise LookupError("not a table")
        meta = df.metadataColumn("_metadata")
        paths = df.select(meta["file_path"].alias("path"), meta["row_index"].alias("at")).groupBy("path").agg(F.max("at").alias("at"))
    except (AnalysisException, LookupError):
        return stage(with_row_id(df, name), "numbered")
    n, longest = paths.agg(F.count("*"), F.max("at")).first()
    bits = max(n - 1, 0).bit_length() * 2  # half of all hash functions or so keep n paths apart
    if (longest or 0) >> 63 - bits:
        return stage(with_row_id(df, name), "numbered")
    file_of = lambda path, seed: F.shiftrightunsigned(F.xxhash64(F.lit(seed), path), 64 - bits) if bits else F.lit(0).cast("bigint")
    seed = 0
    while bits:
        counts = tuple(paths.agg(*[F.countDistinct(file_of(F.col("path"), k)).alias(f"k{k}") for k in range(seed, seed + 8)]).first())
        seed += next((k for k in range(8) if counts[k] == n), 8)
        if n in counts:
            break
    return df.withColumn(name, F.shiftleft(file_of(meta["file_path"], seed), 63 - bits) + meta["row_index"])


# ---------------------------------------------------------------- Arrow batches


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; null counts as empty.  No copy for plain strings."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    if not wide and not pa.types.is_string(column.type):
        column, wide = column.cast(pa.large_string()), True
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[column.offset: column.offset + len(column) + 1].astype(np.int64) if offsets else np.zeros(1, np.int64)
    body = np.frombuffer(data, np.uint8)[at[0]: at[-1]] if data is not None and len(at) > 1 else np.zeros(0, np.uint8)
    return body, at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes (a longer row is a range of its own)."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


def byte_table(is_word) -> np.ndarray:
    return np.array([bool(is_word(b)) for b in range(256)])


# Word classes of the contracts, by UTF-8 byte: every byte of a non-ASCII character is a word byte.
ALNUM_WORD = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
SPACED_WORD = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def word_spans(body: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of every row, and the n + 1 positions of the rows in those arrays."""
    flags = word[body]
    before = np.empty_like(flags)
    before[:1] = False
    before[1:] = flags[:-1]
    inner = offsets[:-1][offsets[:-1] < len(body)]
    before[inner] = False
    starts = np.flatnonzero(flags & ~before)
    after = np.empty_like(flags)
    after[-1:] = False
    after[:-1] = flags[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(flags & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def joined_words(body: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[bytes, np.ndarray]:
    """A buffer that holds each row as a newline, a space and its lower-cased words with a space after each.

    Also returns each word's place in the buffer.  The words are copied in
    parts, so that a very long row needs no more than its own bytes besides.
    """
    n_words, n_rows = len(starts), len(rows) - 1
    sizes = ends - starts
    places = np.zeros(n_words + 1, np.int64)
    np.cumsum(sizes + 1, out=places[1:])
    total = int(places[-1]) + 2 * n_rows
    heads = places[rows[:-1]] + 2 * np.arange(n_rows)
    places = places[:-1] + 2 * (np.repeat(np.arange(n_rows), np.diff(rows)) + 1)
    out = np.full(total, 0x20, np.uint8)
    out[heads] = 0x0A
    for i in range(0, n_words, 1 << 17):
        own, part = sizes[i:i + (1 << 17)], starts[i:i + (1 << 17)]
        inside = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
        out[inside + np.repeat(places[i:i + (1 << 17)], own)] = LOWER[body[inside + np.repeat(part, own)]]
    return out.tobytes(), places
