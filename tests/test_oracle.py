"""Every registered query against its DuckDB SQL, on the smallest test data."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import check  # noqa: E402
from ratesmith.plans.queries import ORACLE_SQL, QUERIES  # noqa: E402

SF = os.environ.get("RATESMITH_TEST_SF", "/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    [(got_name, ok, msg)] = check(spark, SF, [name], exact=True)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "asset", "quote", "rate"]
    assert df.count() == 777
