"""Every registered query that has a SQL text gives the same columns, types and rows as that text."""

import pytest

from snapdelta.queries import ORACLES, QUERIES
from tests.oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    frame = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert differences(frame, connection, ORACLES[name]) == []
    else:
        assert frame.count() > 0


def test_entry_runs(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
