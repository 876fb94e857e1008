"""Each check catches its planted defect and passes on equal layers."""

import pytest
from pyspark.sql import functions as F

from tests.plans import count, plan
from tidemark.operators import quality as Q
from tidemark.operators.enrich import add_lineage
from tidemark.spec import LoadType, TableSpec

SPEC = TableSpec("srv", "db", "dbo", "t", ("id",), "at")


@pytest.fixture
def layers(spark):
    left = spark.sql("SELECT CAST(id AS INT) id, IF(id = 3, NULL, 'x') a, IF(id = 4, NULL, 'y') b, now() at FROM range(6)")
    return left, add_lineage(left, SPEC)


def passes(check):
    return Q.failures(check).isEmpty()


def test_equal_layers_pass(layers):
    left, right = layers
    for check in (Q.count_parity, Q.null_parity, Q.total_null_parity):
        assert passes(check(left, right))
    assert passes(Q.null_keys(left, right, ["id"]))
    assert Q.same_schema(left, right)


def test_lost_and_repeated_rows(layers):
    left, right = layers
    assert not passes(Q.count_parity(left, right.where("id <> 2")))
    assert not passes(Q.count_parity(left, right.union(right.where("id = 2"))))


def test_null_key(layers):
    left, right = layers
    broken = right.withColumn("id", F.nullif("id", F.lit(2)))
    assert [r.column for r in Q.failures(Q.null_keys(left, broken, ["id"])).collect()] == ["id"]


def test_offsetting_nulls_pass_in_total_but_not_per_column(layers):
    left, right = layers
    moved = right.withColumns({"a": F.lit("x"), "b": F.when(F.col("id") < 4, "y")})
    assert passes(Q.total_null_parity(left, moved))
    assert sorted(r.column for r in Q.failures(Q.null_parity(left, moved)).collect()) == ["a", "b"]


def test_changed_type_and_missing_column(layers):
    left, right = layers
    changed = right.withColumn("id", F.col("id").cast("string")).drop("b")
    assert not Q.same_schema(left, changed)
    found = {r.column: (r.left_type, r.right_type) for r in Q.type_differences(left, changed.select("id", "a", "at")).collect()}
    assert found == {"id": ("int", "string"), "b": ("string", None)}


def test_dtype_comparison_of_two_layers(spark):
    """Six shared columns, one of which changed its type."""
    shared = "source_server string, source_database string, source_table string, medallion_layer string, data_lake_path string"
    landing = spark.createDataFrame([("landing_incremental", *"abcde")], f"load_type string, {shared}")
    bronze = spark.createDataFrame([(1, *"abcde")], f"load_type int, {shared}")
    assert [tuple(r) for r in Q.type_differences(landing, bronze).collect()] == [("load_type", "string", "int")]


def test_catalog_comparison(spark):
    spark.range(1).write.mode("overwrite").saveAsTable("dq_left")
    spark.range(1).select(F.col("id").cast("string")).write.mode("overwrite").saveAsTable("dq_right")
    assert [tuple(r) for r in Q.catalog_type_differences(spark, "dq_left", "dq_right").collect()] == [("id", "bigint", "string")]


def test_partition_date_is_a_system_column(layers):
    left, right = layers
    full = TableSpec("srv", "db", "dbo", "t", ("id",), load_type=LoadType.FULL)
    assert set(right.columns) - set(add_lineage(left, full).columns) == {"__PartitionDateUTC"}


def test_profile_is_one_pass(layers):
    text = plan(Q.null_profile(layers[0]))
    assert count(text, "Range") + count(text, "Scan") == 1
    assert count(text, "Exchange") == 1


def test_row_count_of_nothing(layers):
    assert Q.row_count(None) == 0 and Q.row_count(layers[0]) == 6
