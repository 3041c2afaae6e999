"""Every registered query against its oracle SQL on the smallest driver data."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from strata.oracle import oracle_sql
from strata.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.helpers import spark_table, table

NAMES = sorted(QUERIES)


def test_every_query_has_oracle_sql():
    assert set(oracle_sql()) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(oracle_sql()) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["dt", "customer_nation", "customer_region"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cur = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    expected = table(ocols, cur.fetchall())
    assert sorted(df.columns) == sorted(ocols)
    got = spark_table(df)
    assert len(got) == len(expected)
    assert got == expected
