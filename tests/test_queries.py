import pytest
from compare import compare

from concilia.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_equals_sql(spark, name):
    compare(spark, catalog.QUERIES[name], catalog.SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
