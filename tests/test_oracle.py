import pytest

from tests.oracle_check import agree
from weft.plans import oracle, queries


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_its_sql(spark, small, name):
    agree(spark, small, queries.queries()[name], oracle.oracle_sql()[name])


def test_every_sql_has_a_query():
    assert set(oracle.oracle_sql()) <= set(queries.queries())
