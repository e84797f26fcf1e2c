"""Every registered query against its DuckDB oracle on sf0.001 (the driver
runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as se
from tests.conftest import SF001
from tests.oracle_check import compare, duck
from trendspark.plans import catalogue


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, SF001, name)
    assert ok, msg


def test_every_query_has_oracle():
    assert set(catalogue.ORACLE) == set(catalogue.QUERIES)


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.columns == ["item_id", "text_count", "channel", "mention_count"]
    assert df.count() > 0
