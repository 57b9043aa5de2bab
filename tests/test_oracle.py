"""Every registered query against its DuckDB twin at sf0.001 (the driver's gate runs sf0.01)."""
import pytest

import __spark_entry__ as E
from helpers import SF_SMALL
from tools.oracle_check import compare, duck

from rentmart.oracle import ORACLE
from rentmart.registry import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_a_twin_or_is_rows_only():
    assert set(ORACLE) == set(QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries()) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    status, msg = compare(spark, con, name, SF_SMALL)
    assert status == "OK", msg


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "listing_neighbourhood" in df.columns
