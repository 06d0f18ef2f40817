"""Every registered query gives the rows of its SQL."""

import os

import pytest
from compare import differences

import __spark_entry__ as engine
from meterlake.queries.registry import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


def test_entry_lists_every_query():
    assert set(QUERIES) <= set(engine.queries())
    assert set(engine.oracle_sql()) <= set(engine.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), ORACLE[name], SF_DIR) == []


def test_entry_has_rows(spark):
    assert engine.entry(spark).count() > 0
