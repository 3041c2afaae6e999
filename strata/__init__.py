"""strata: a Spark-native medallion pipeline over a TPC-H style order schema.

Layers: sources (JDBC, Parquet fixtures, ``.tbl`` text) -> bronze snapshots ->
silver dimensions and fact -> gold wide table and marts -> dashboard views.
Every step is a lazy DataFrame plan; Spark executes it when a snapshot is
written or a consumer pulls the result.
"""

__version__ = "0.1.0"
