"""The driver's entry points work with and without the optional operators."""

import pytest

import __spark_entry__
from pelagia import driver_queries

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_names_agree():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(driver_queries.QUERIES))
def test_query_runs(spark, name):
    assert driver_queries.QUERIES[name](spark, SF).count() > 0
