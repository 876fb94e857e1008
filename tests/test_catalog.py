"""Every registered query against its SQL, over the whole tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, differences
from tidemark import catalog


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_sql(spark, sf_dir, connection, name):
    df = entry.queries()[name](spark, sf_dir)
    assert differences(df, entry.oracle_sql()[name], connection) == []


def test_every_query_has_sql():
    assert catalog.queries().keys() == catalog.oracles().keys()
    assert catalog.queries().keys() <= entry.queries().keys()


def test_entry_has_a_stable_schema(spark):
    first, second = entry.entry(spark), entry.entry(spark)
    assert first.schema == second.schema
    assert first.count() > 0
