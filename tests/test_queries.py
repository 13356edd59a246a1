import pytest

import oracle
from herald import registry


@pytest.fixture(scope="module")
def con():
    return oracle.connect()


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_matches_sql(spark, con, name):
    oracle.check(spark, con, name)


def test_every_query_has_sql():
    assert registry.QUERIES.keys() == registry.ORACLES.keys()


def test_entry(spark):
    import __spark_entry__ as contract
    df = contract.entry(spark)
    assert df.columns == ["location_tag", "qualified", "in_flow", "open_rate", "inventory_count"]
    assert df.count() > 0
    assert contract.queries().keys() >= contract.oracle_sql().keys()
