"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest

from compare import differences, oracle_connection
from sluice.oracle import ORACLES
from sluice.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, name, FOLDER) == []


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 200
    assert set(__spark_entry__.queries()) >= set(QUERIES)
