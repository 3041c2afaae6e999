"""Bronze layer: source tables stamped with the run's ``etl_inserted``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.schemas import STAMP


def bronze(source_df: DataFrame, run_ts: str) -> DataFrame:
    """``SELECT *, <run stamp> AS etl_inserted`` over a whole source table."""
    return source_df.withColumn(STAMP, F.lit(run_ts))
