"""Every query gives the rows its SQL gives."""

from __future__ import annotations

import pytest
from conftest import DATA

from sievebed.catalog import CATALOG


def test_every_query_has_sql():
    assert [name for name, query in CATALOG.items() if query.sql is None] == []


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_matches_sql(spark, oracle, assert_same, name):
    query = CATALOG[name]
    assert_same(query.run(spark, DATA), oracle.sql(query.sql))
