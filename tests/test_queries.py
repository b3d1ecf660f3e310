"""Every registered query against its SQL on the smallest tables, and the driver contract."""

from __future__ import annotations

import pytest

import __spark_entry__ as spark_entry
from tests.compare import connect, differences
from tierkeep.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


def test_registered():
    assert QUERIES.keys() <= spark_entry.queries().keys()
    assert ORACLES.keys() <= spark_entry.oracle_sql().keys()


def test_entry(spark):
    result = spark_entry.entry(spark)
    assert result.columns == ["app_id", "discount_percent", "valid_from", "valid_to", "is_current"]
    assert result.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), ORACLES[name], duck) == []
