"""JDBC reads, incremental and full, optionally split over several connections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.watermarks import filter_since
from tidemark.spec import TableSpec


@dataclass(frozen=True)
class Split:
    """Range split of one numeric, date or timestamp column over ``partitions`` concurrent reads."""

    column: str
    lower: str
    upper: str
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.partitions),
        }


def jdbc_options(
    spec: TableSpec, url: str, connection: Mapping[str, str] | None = None, split: Split | None = None
) -> dict[str, str]:
    """Reader options; ``connection`` carries driver, user, password, fetchsize and the like."""
    return {
        "fetchsize": "10000",
        **(connection or {}),
        "url": url,
        "dbtable": spec.qualified_table,
        **(split.options() if split else {}),
    }


def read_full(
    spark: SparkSession,
    spec: TableSpec,
    url: str,
    connection: Mapping[str, str] | None = None,
    split: Split | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The whole source table; without ``split`` one task pulls all of it."""
    df = spark.read.format("jdbc").options(**jdbc_options(spec, url, connection, split)).load()
    return df.select(*columns) if columns else df


def read_incremental(
    spark: SparkSession,
    spec: TableSpec,
    url: str,
    connection: Mapping[str, str] | None = None,
    split: Split | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows past the spec's watermark.  Spark turns the filter and the projection into the source's SQL."""
    return filter_since(read_full(spark, spec, url, connection, split, columns), spec.watermark, spec.last_loaded)


def read_source(
    spark: SparkSession,
    spec: TableSpec,
    url: str,
    connection: Mapping[str, str] | None = None,
    split: Split | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Dispatch on the spec's load type."""
    reader = read_incremental if spec.incremental else read_full
    return reader(spark, spec, url, connection, split, columns)
