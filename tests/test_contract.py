import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, connect

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, connection, name):
    df = queries()[name](spark, SMALL)
    if name in oracle_sql():
        assert compare(df, connection, oracle_sql()[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_its_query():
    assert set(oracle_sql()) <= set(queries())
