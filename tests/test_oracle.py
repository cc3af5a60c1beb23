"""Every registered query against its SQL twin on the smallest driver tables."""

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, con):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        rows, differences = compare(df, ORACLES[name], con)
        assert differences == []
        assert rows > 0
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
