import pytest

from tallyweir.plans import registry
from tests.oracle import SF, compare

QUERIES, SQL = registry.queries(), registry.oracles()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    compare(spark, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_gives_no_row_twice(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() == df.distinct().count() > 0


def test_entry():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
