"""Data-quality checks between two layers of a table.

Each check is one pass over each side and yields a small frame; ``ok`` is true where the sides agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.enrich import drop_system_columns
from tidemark.sources.rows import local_frame


def row_count(df: DataFrame | None) -> int:
    """Number of rows; a missing frame has none."""
    return 0 if df is None else df.count()


def _both(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.withColumn("side", F.lit("left")).unionByName(right.withColumn("side", F.lit("right")))


def _side(value: str, side: str) -> Column:
    return F.max(F.when(F.col("side") == side, F.col(value)))


def count_parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: the two row counts and whether they agree."""
    counts = _both(left.agg(F.count("*").alias("n")), right.agg(F.count("*").alias("n")))
    sides = counts.agg(_side("n", "left").alias("left_rows"), _side("n", "right").alias("right_rows"))
    return sides.withColumn("ok", F.col("left_rows") == F.col("right_rows"))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count per column, all columns in a single aggregation."""
    counted = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)])
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("nulls")) for i, c in enumerate(df.columns)
    ]
    return counted.select(F.inline(F.array(*entries)))


def null_parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """Null counts side by side per column, system columns left aside.

    Comparing per column also finds errors that cancel out in the total; a column only one side has is not ok.
    """
    profiles = _both(null_profile(drop_system_columns(left)), null_profile(drop_system_columns(right)))
    sides = profiles.groupBy("column").agg(
        _side("nulls", "left").alias("left_nulls"), _side("nulls", "right").alias("right_nulls")
    )
    return sides.withColumn("ok", F.col("left_nulls").eqNullSafe(F.col("right_nulls")))


def total_null_parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: the two totals over all columns."""
    totals = null_parity(left, right).agg(
        F.sum("left_nulls").alias("left_nulls"), F.sum("right_nulls").alias("right_nulls")
    )
    return totals.withColumn("ok", F.col("left_nulls") == F.col("right_nulls"))


def null_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a null in each key column, per side; ok when neither side has one."""
    profiles = _both(null_profile(left.select(*keys)), null_profile(right.select(*keys)))
    sides = profiles.groupBy("column").agg(
        _side("nulls", "left").alias("left_nulls"), _side("nulls", "right").alias("right_nulls")
    )
    return sides.withColumn("ok", (F.col("left_nulls") == 0) & (F.col("right_nulls") == 0))


def _type_rows(spark: SparkSession, types: list[tuple[str, str]]) -> DataFrame:
    return local_frame(spark, types, "column string, dtype string")


def _type_report(spark: SparkSession, left: list[tuple[str, str]], right: list[tuple[str, str]]) -> DataFrame:
    sides = _both(_type_rows(spark, left), _type_rows(spark, right)).groupBy("column").agg(
        _side("dtype", "left").alias("left_type"), _side("dtype", "right").alias("right_type")
    )
    return sides.withColumn("ok", F.col("left_type").eqNullSafe(F.col("right_type")))


def type_report(left: DataFrame, right: DataFrame) -> DataFrame:
    """Data type per column on both sides; null where a side lacks the column."""
    return _type_report(left.sparkSession, left.dtypes, right.dtypes)


def type_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    return type_report(left, right).where(~F.col("ok")).drop("ok")


def catalog_type_differences(spark: SparkSession, left: str, right: str) -> DataFrame:
    """The same for two catalog tables, from their metadata alone."""
    types = [[(c.name, c.dataType) for c in spark.catalog.listColumns(table)] for table in (left, right)]
    return _type_report(spark, *types).where(~F.col("ok")).drop("ok")


def same_schema(left: DataFrame, right: DataFrame) -> bool:
    """Equal column names, order and types once the system columns are dropped."""
    return drop_system_columns(left).dtypes == drop_system_columns(right).dtypes


def failures(check: DataFrame) -> DataFrame:
    """The rows of a check that did not pass; nulls count as failed."""
    return check.where(~F.coalesce(F.col("ok"), F.lit(False)))
