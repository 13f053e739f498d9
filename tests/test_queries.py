import pytest

from oracle import same
from skysift import catalogue

SF = "/root/testdata/sf0.001"
SQL, QUERIES = catalogue.oracle_sql(), catalogue.queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    same(QUERIES[name](spark, SF), SQL[name], SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
