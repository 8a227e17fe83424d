import pytest
from oracle import assert_same

from gleaner.plans import registry

registry.load()


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert_same(spark, sf_dir, registry.QUERIES[name], registry.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_runs(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 5
    assert set(e.oracle_sql()) <= set(e.queries())
