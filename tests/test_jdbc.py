"""JDBC options and dispatch.  No database is started: the reader is replaced by one that hands out a fixed frame."""

from datetime import datetime

import pytest

from tidemark.sources import jdbc
from tidemark.sources.jdbc import Split, jdbc_options
from tidemark.spec import LoadType, TableSpec

INCREMENTAL = TableSpec("h", "db", "dbo", "calls", ("k",), "at", last_loaded=datetime(2024, 1, 2))
FULL = TableSpec("h", "db", "dbo", "codes", ("k",), load_type=LoadType.FULL)


class Reader:
    def __init__(self, df):
        self.df, self.read, self.used = df, self, {}

    def format(self, name):
        self.used["format"] = name
        return self

    def options(self, **options):
        self.used |= options
        return self

    def load(self):
        return self.df


@pytest.fixture
def reader(spark):
    return Reader(spark.createDataFrame([(1, datetime(2024, 1, 2)), (2, datetime(2024, 1, 3))], "k int, at timestamp_ntz"))


def test_options():
    split = Split("k", "1", "1000", 16)
    got = jdbc_options(FULL, "jdbc:x", {"user": "u", "fetchsize": "5"}, split)
    assert got == {
        "fetchsize": "5", "user": "u", "url": "jdbc:x", "dbtable": "dbo.codes",
        "partitionColumn": "k", "lowerBound": "1", "upperBound": "1000", "numPartitions": "16",
    }


def test_incremental_is_strict(reader):
    assert [r.k for r in jdbc.read_source(reader, INCREMENTAL, "jdbc:x").collect()] == [2]
    assert reader.used["dbtable"] == "dbo.calls" and reader.used["format"] == "jdbc"


def test_full_reads_everything_and_projects(reader):
    df = jdbc.read_source(reader, FULL, "jdbc:x", columns=["k"])
    assert df.columns == ["k"] and df.count() == 2
