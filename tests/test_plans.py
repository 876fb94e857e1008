"""What must hold of the physical plans for them to hold up on large tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.plans import count, plan
from tidemark import catalog
from tidemark.operators.watermarks import batch_watermarks, filter_lookback, filter_since
from tidemark.plans.fact import FactSpec, build_fact, refresh_fact


@pytest.fixture
def shuffled(spark):
    """Small tests would broadcast everything; large tables cannot."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("build", [filter_since, filter_lookback])
def test_watermarks_reach_the_scan(spark, sf_dir, build):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    text = plan(build(orders, "o_orderdate", datetime(1998, 6, 1)), "formatted")
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan" in text


def test_only_needed_columns_are_read(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = plan(batch_watermarks(events, "ts", ["event_type"]), "formatted")
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text


def test_group_maximum_is_folded_map_side(spark, sf_dir):
    text = plan(batch_watermarks(spark.read.parquet(f"{sf_dir}/events.parquet"), "ts", ["event_type"]))
    assert "partial_max" in text and count(text, "Exchange") == 1


KEYS = ("a", "b")
SPEC = FactSpec(keys=KEYS, base={"a": "a", "b": "b", "x": "x"}, attributes={"y": "y"}, nullable_keys=False)


def sides(spark):
    base = spark.range(100).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b"), F.lit(1).alias("x"), F.lit("u").alias("unused"))
    return base, base.select("a", "b", F.lit(2).alias("y"))


def test_fact_shuffles_each_side_once(spark, shuffled):
    text = plan(build_fact(*sides(spark), SPEC))
    assert count(text, "Exchange") == 2 and "unused" not in text


def test_refresh_of_few_keys_shuffles_only_their_rows(spark, shuffled):
    base, attributes = sides(spark)
    text = plan(refresh_fact(base, attributes, base.where("a < 10").select(*KEYS), SPEC))
    assert count(text, "BroadcastHashJoin") == 2
    for line, below in zip(text.splitlines(), text.splitlines()[1:]):
        if "hashpartitioning(a#" in line and "BroadcastHashJoin" not in below:
            assert "Aggregate" in below or "Project" in below


def test_refresh_of_many_keys_shuffles_whole_tables_once(spark, shuffled, monkeypatch):
    """Base, attributes and the key list (for either side) once each; then the affected rows for the final join."""
    monkeypatch.setattr("tidemark.operators.joins.BROADCAST_ROWS", 0)
    base, attributes = sides(spark)
    affected = base.where("a < 10").select(*KEYS)
    text = plan(refresh_fact(base, attributes, affected, SPEC))
    assert count(text, "SortMergeJoin") + count(text, "ShuffledHashJoin") == 3
    assert count(text, "Exchange") <= 6


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_python_and_no_products(spark, sf_dir, name):
    """No query leaves the JVM, multiplies tables or orders a whole table in one task."""
    if name in ("medallion_two_batches", "medallion_full_load", "bronze_stream", "upsert_moving_partitions", "gold_fact_two_batches"):
        pytest.skip("its result is a plain scan of what it wrote")
    text = plan(entry.queries()[name](spark, sf_dir))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text
    lines = text.splitlines()
    for line, below in zip(lines, lines[1:]):
        # A single task may only ever receive what an aggregation has already folded.
        assert "Exchange SinglePartition" not in line or "Aggregate" in below
