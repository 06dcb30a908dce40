import pytest

from oracle_check import connect, difference
from workload.oracle import ORACLE
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, sf_dir, db, name):
    assert difference(QUERIES[name](spark, sf_dir), db, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_without_sql_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
