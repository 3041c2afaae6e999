from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


@pytest.fixture(scope="session")
def spark():
    from pyspark import SparkConf

    from strata.session import build_session

    # Tests set their own shared root only when the launch settings have none; it is a setting of the launch.
    own = {} if SparkConf().contains("spark.checkpoint.dir") else {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="strata-tests-")}
    s = build_session("local[4]", app_name="strata-tests", shuffle_partitions=8, extra_conf=own)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.fixture()
def tmp_root(spark):
    from strata.session import scratch_dir

    return scratch_dir(spark, "test")
