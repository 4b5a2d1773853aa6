from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


WAREHOUSE = [name for name in entry.queries() if name not in entry._corpus_queries()]


@pytest.mark.parametrize("name", WAREHOUSE)
def test_query_equals_sql(spark, connection, name):
    assert difference(entry.queries()[name](spark, SF), connection, entry.oracle_sql()[name]) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 1500
