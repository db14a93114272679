import pytest

from quirekit.plans import catalog
from tests.oracle import both

ORACLES = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf, name):
    cols, others, ours, theirs = both(spark, sf, catalog.queries()[name], ORACLES[name])
    assert cols == others
    assert ours == theirs


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(ORACLES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
