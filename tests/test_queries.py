"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from stackweave.plans import catalog, checks
from tests import compare

QUERIES = catalog.QUERIES
SQL = checks.STATEMENTS


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, small, con, name):
    df = QUERIES[name](spark, small)
    if name in SQL:
        assert compare.difference(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_every_statement_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
