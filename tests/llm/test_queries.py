"""The registered queries over the whole test tables, with SQL where there is any."""

import pytest

from tests.oracle import connect, differences
from tidemark.llm.queries import ORACLES, QUERIES

ROWS_OF = {"op2": "documents", "op6": "documents", "op7": "documents", "op8": "documents", "op9": "documents", "op10": "documents"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), ORACLES[name], connect(sf_dir)) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs_over_its_whole_table(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).count()
    table = ROWS_OF.get(name.split("_")[0])
    assert rows == spark.read.parquet(f"{sf_dir}/{table}.parquet").count() if table else rows > 0


def test_every_number_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
