"""Every query with a SQL twin gives the same names, counts and values."""

from __future__ import annotations

import pytest
from oracle_check import compare, connect

from rarespark.plans import catalog


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_twin(spark, sf, con, name):
    assert compare(catalog.QUERIES[name](spark, sf), con, catalog.ORACLES[name]) == ""


def test_every_twin_has_a_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
