"""Every registered query returns the rows its SQL statement returns."""

import compare
import pytest

import __spark_entry__ as registry
from effortlens.checks.queries import all_queries


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_a_statement():
    assert set(all_queries()) <= set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_statement(spark, sf_dir, duck, name):
    result = registry.queries()[name](spark, sf_dir)
    assert compare.difference(result, duck, registry.oracle_sql()[name]) is None


def test_entry_runs(spark):
    assert registry.entry(spark).count() > 0
