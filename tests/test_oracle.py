"""Every registered query equals its DuckDB oracle (driver-style compare).

Runs at sf0.001 by default; set ORACLE_SF_DIR=/root/testdata/sf0.01 for the
driver's scale.  The training-data operators have tests of their own (tests/llm).
"""

import os

import pytest

import __spark_entry__ as entry
from changefold.plans.catalogue import QUERIES
from oracle_compare import compare

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, [name], verbose=False)[name]
    assert res.get("match"), res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["delivery_date", "status", "order_count"]
    assert df.count() == 898
