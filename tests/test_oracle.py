"""Every query equals its SQL counterpart, types included."""

import pytest
from compare import connect, difference

from __spark_entry__ import oracle_sql, queries
from pagemill.plans.oracle import ORACLE_SQL
from pagemill.plans.queries import QUERIES
from pagemill.plans.round_trips import QUERIES as ROUND_TRIPS

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() | ROUND_TRIPS.keys() == ORACLE_SQL.keys()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, duck, name):
    assert difference(spark, duck, SF_DIR, queries()[name], oracle_sql()[name]) is None
