import pytest

from deltaloom.plans import catalog
from tests.oracle import connect, same

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql(spark, duck, name):
    same(catalog.queries()[name](spark, SF), duck, catalog.oracle_sql()[name])


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
