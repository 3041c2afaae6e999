"""Source connectors.  Every source exposes ``table(name) -> DataFrame``."""

from strata.sources.fixtures import FixtureSource
from strata.sources.parquet import ParquetSource
from strata.sources.jdbc import JdbcConfig, JdbcSource, SourceConfigError, split_table_name
from strata.sources.tbl import RejectedLines, TblSource, read_tbl, tbl_line, write_tbl

__all__ = [
    "FixtureSource",
    "JdbcConfig",
    "JdbcSource",
    "ParquetSource",
    "RejectedLines",
    "SourceConfigError",
    "TblSource",
    "read_tbl",
    "split_table_name",
    "tbl_line",
    "write_tbl",
]
