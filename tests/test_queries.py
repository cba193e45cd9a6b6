"""Every registered query at the smallest scale: equal to its SQL, or at least runnable."""

import pytest

from fernwick.plans.catalog import QUERIES, SQL
from tests.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    message, _, _ = compare(spark, con, FOLDER, QUERIES[name], SQL.get(name))
    assert message is None, message


def test_sql_names_are_queries():
    assert set(SQL) <= set(QUERIES)


def test_contract(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns and df.count() > 0
    assert entry.queries().keys() >= entry.oracle_sql().keys()
