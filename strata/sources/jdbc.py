"""Relational-database source over JDBC.

Every table is read whole (no source filter), like the original full load.
Reads are split into parallel range queries on the table's first key column.
The ranges hold about as many rows each, however the keys are spread: a
histogram of the key, counted by the database, gives them, and buckets that
hold more than a range may are counted again in finer ones.  There are as many
ranges as the table's rows ask for.  CHAR(n) columns are right-trimmed.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import CHAR_COLUMNS, SOURCE_KEYS

# The five settings the source needs, in this order.
REQUIRED_SETTINGS = ("UPS_HOST", "UPS_PORT", "UPS_DATABASE", "UPS_USERNAME", "UPS_PASSWORD")
DEFAULT_SCHEMA = "public"


class SourceConfigError(EnvironmentError):
    """Raised when source settings are missing; lists every missing name."""


@dataclass(frozen=True)
class JdbcConfig:
    host: str
    port: str
    database: str
    user: str
    password: str
    driver: str = "org.postgresql.Driver"
    subprotocol: str = "postgresql"

    @property
    def url(self) -> str:
        return f"jdbc:{self.subprotocol}://{self.host}:{self.port}/{self.database}"

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> JdbcConfig:
        env = os.environ if env is None else env
        missing = [k for k in REQUIRED_SETTINGS if env.get(k) is None]
        if missing:
            raise SourceConfigError(f"missing settings: {', '.join(missing)}")
        host, port, db, user, pwd = (env[k] for k in REQUIRED_SETTINGS)
        return cls(host=host, port=port, database=db, user=user, password=pwd)


def split_table_name(table_name: str) -> tuple[str, str]:
    """``"schema.table"`` -> (schema, table); a bare name is in ``public``."""
    parts = table_name.split(".")
    if len(parts) == 1:
        return DEFAULT_SCHEMA, parts[0]
    if len(parts) == 2 and all(parts):
        return parts[0], parts[1]
    raise ValueError(f"expected 'table' or 'schema.table', got {table_name!r}")


# Buckets of one histogram query, and how often a bucket may be counted again in finer ones.
HISTOGRAM_BUCKETS, MOST_ROUNDS = 1024, 8
# Rows of one range query, unless the number of partitions is given.
ROWS_PER_PARTITION = 2_000_000

Rows = Sequence[tuple]


def histogram_sql(table: str, key: str, low: int, high: int, buckets: int) -> tuple[str, int]:
    """SQL for (bucket number, rows) of the keys from ``low`` up to but not including ``high``, and the width of a bucket."""
    width = max(1, -(-(high - low) // buckets))
    return f"SELECT FLOOR(({key} - ({low})) / {width}.0) AS bucket, COUNT(*) AS n FROM {table} WHERE {key} >= {low} AND {key} < {high} GROUP BY 1", width


def key_histogram(query: Callable[[str], Rows], table: str, key: str, low: int, high: int, target: int, buckets: int = HISTOGRAM_BUCKETS,
                  rounds: int = MOST_ROUNDS) -> list[tuple[int, int, int]]:
    """(first key, key after the last, rows) of ranges in order; none above ``target`` rows but single keys.

    The database counts; a histogram has ``buckets`` rows at most.
    """
    sql, width = histogram_sql(table, key, low, high, buckets)
    out = []
    for bucket, n in sorted((int(b), int(n)) for b, n in query(sql)):
        first = low + bucket * width
        last = min(high, first + width)
        if n > target and last - first > 1 and rounds > 1:
            out += key_histogram(query, table, key, first, last, target, buckets, rounds - 1)
        else:
            out.append((first, last, n))
    return out


def balanced_ranges(histogram: Sequence[tuple[int, int, int]], target: int) -> list[int]:
    """The keys at which a new range starts, so that ranges hold ``target`` rows or fewer where single buckets do."""
    starts, held = [], 0
    for first, _, n in histogram:
        if held and held + n > target:
            starts.append(first)
            held = 0
        held += n
    return starts


def range_predicates(key: str, starts: Sequence[int]) -> list[str]:
    """Predicates of which every row satisfies exactly one: NULL keys and keys that appear meanwhile below or above are in the first and last."""
    if not starts:
        return []
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(starts, starts[1:])]
    return [f"{key} < {starts[0]} OR {key} IS NULL", *inner, f"{key} >= {starts[-1]}"]


class JdbcSource:
    """Reads whole source tables from a relational database."""

    name = "jdbc"

    def __init__(
        self,
        spark: SparkSession,
        config: JdbcConfig | None = None,
        num_partitions: int | None = None,
        fetch_size: int = 10_000,
        rows_per_partition: int = ROWS_PER_PARTITION,
        keys: Mapping[str, tuple[str, ...]] = SOURCE_KEYS,
        char_columns: Mapping[str, tuple[str, ...]] = CHAR_COLUMNS,
    ) -> None:
        self.spark = spark
        self.config = config or JdbcConfig.from_env()
        self.num_partitions = num_partitions
        self.rows_per_partition = rows_per_partition
        self.fetch_size = fetch_size
        self.keys = keys
        self.char_columns = char_columns

    def options(self, table_name: str) -> dict[str, str]:
        schema, table = split_table_name(table_name)
        return {
            "url": self.config.url,
            "driver": self.config.driver,
            "user": self.config.user,
            "password": self.config.password,
            "dbtable": f"{schema}.{table}",
            "fetchsize": str(self.fetch_size),
        }

    def _query(self, table_name: str, sql: str) -> Rows:
        """Rows of a query that the database runs; for a few rows only."""
        options = self.options(table_name) | {"dbtable": f"({sql}) q"}
        return [tuple(r) for r in self.spark.read.format("jdbc").options(**options).load().collect()]

    def predicates(self, table_name: str, query: Callable[[str], Rows] | None = None) -> list[str]:
        """Range predicates of about as many rows each, from the database's own counts; none for a table of one range or without an integer key."""
        schema, table = split_table_name(table_name)
        key = (self.keys.get(table) or (None,))[0]
        if key is None or self.num_partitions == 1:
            return []
        query = query or (lambda sql: self._query(table_name, sql))
        ((low, high, n),) = query(f"SELECT MIN({key}) AS lo, MAX({key}) AS hi, COUNT(*) AS n FROM {schema}.{table}")
        target = -(-int(n) // self.num_partitions) if self.num_partitions else self.rows_per_partition
        if low is None or int(n) <= target:
            return []
        histogram = key_histogram(query, f"{schema}.{table}", key, int(low), int(high) + 1, max(1, target))
        return range_predicates(key, balanced_ranges(histogram, max(1, target)))

    def table(self, name: str) -> DataFrame:
        qualified = name if "." in name else f"{DEFAULT_SCHEMA}.{name}"
        bare, options = split_table_name(qualified)[1], self.options(qualified)
        wanted = self.predicates(qualified)
        if wanted:
            own = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
            df = self.spark.read.jdbc(options["url"], options["dbtable"], predicates=wanted, properties=own)
        else:
            df = self.spark.read.format("jdbc").options(**options).load()
        chars = set(self.char_columns.get(bare, ()))
        if chars:
            df = df.select(*[F.rtrim(F.col(c)).alias(c) if c in chars else F.col(c) for c in df.columns])
        return df
