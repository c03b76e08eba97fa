import pytest
from compare import check
from conftest import SF

import __spark_entry__ as entry
from tickloom.registry.oracles import all_oracles
from tickloom.registry.queries import all_queries


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_equals_sql(spark, name):
    problem, rows = check(spark, SF, name)
    assert problem is None, problem
    assert rows > 0 or name.startswith("dash_")  # the smallest tables lack anomalies on that day


def test_entry(spark):
    assert entry.entry(spark).count() > 0
