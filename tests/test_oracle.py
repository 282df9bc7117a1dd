"""Every registered query against its SQL in the second engine, at the smallest scale."""

import pytest

import __spark_entry__ as registry
from checks.compare import connect, differences
from checks.oracle import all_oracles

FOLDER = "/root/testdata/sf0.001"
NAMES = list(all_oracles())
# Nobody returns on that day at the smallest scale; see test_models for the rules.
MAY_BE_EMPTY = {"returning_players", "returning_players_order"}


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    optional = registry.text_queries.queries() if registry.text_queries else {}
    assert set(registry.queries()) - {*optional, "pipeline"} == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, connection, name):
    found = differences(registry.queries()[name](spark, FOLDER), connection, registry.oracle_sql()[name])
    assert found == (["no rows"] if name in MAY_BE_EMPTY else [])


def test_entry(spark):
    result = registry.entry(spark)
    assert result.count() == 25 and "streak_label" in result.columns
