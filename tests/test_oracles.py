"""Every registered query against its DuckDB twin on the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import compare, duck  # noqa: E402
from early_warning.plans.queries import ORACLES, QUERIES, ROWS_ONLY  # noqa: E402

KEYS = sorted(ORACLES)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, sf_dir, key):
    line = compare(spark, con, key, entry.queries()[key], entry.oracle_sql()[key], sf_dir)
    assert " OK " in line, line


def test_every_query_has_an_oracle_or_is_listed_rows_only():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "start_idx" in df.columns
