"""Registered queries against their SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests_compare import compare, connect

SMALL = "/root/testdata/sf0.001"
# One query per area; ``python tests/tests_compare.py DIR`` runs them all.
CHECKED = ["filtered_features", "processed_long", "adduct_pairs", "replicate_long", "joined_modes", "pi_geometry", "chart_pages", "prepare"]


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", CHECKED)
def test_query(spark, con, name):
    problem, n = compare(spark, con, name, SMALL)
    assert problem is None and n > 0


def test_registry():
    assert set(entry.oracle.oracle()) == set(entry.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
