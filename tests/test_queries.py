"""Every registered query against its SQL twin at the smallest scale."""

from pathlib import Path

import pytest
from compare import differences, duck

import __spark_entry__ as entry
from gridspark.oracles import ORACLES
from gridspark.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    rows, notes = differences(spark, con, SF_DIR, name)
    assert not notes
    assert rows > 0
