"""Every registered query against its oracle SQL on the smallest data."""

import os

import pytest

from registry import ORACLE, QUERIES
from registry.compare import compare, oracle_connection

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test data")
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, message, _ = compare(spark, con, QUERIES[name], ORACLE[name], SF_DIR)
    assert ok, message
