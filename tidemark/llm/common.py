"""What several operators share: words, unique row keys, stored intermediate tables."""

from __future__ import annotations

import contextlib
import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

SPACE_PATTERN = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def bound_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """Let Arrow batches hold ``size`` bytes at most, so that a task's memory does not follow the length of its texts."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).rstrip("b")) > size:
        spark.conf.set(name, size)


def release_memory() -> None:
    """Give freed memory back to the system: Python workers are used again by later stages and would keep it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The runs of characters other than ASCII white space; an empty array for null, empty or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_PATTERN))


def let(value: Column, body) -> Column:
    """Bind ``value`` to a lambda variable, so that ``body`` may use it often and it is computed once."""
    return F.transform(F.array(value), body)[0]


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """``columns`` with a unique, non-null ``key``.

    Where the id already is one, it is the key and nothing is written.  Otherwise (null or repeated ids) rows are
    numbered and stored, so that each row stays a document of its own.
    """
    ids = df.select(F.col(id_col).alias("i"))
    repeated = ids.groupBy("i").count().filter((F.col("count") > 1) | F.col("i").isNull()).limit(1)
    if repeated.isEmpty():
        return df.select(F.col(id_col).cast("long").alias("key"), *columns)
    return stored(df.select(F.monotonically_increasing_id().alias("key"), *columns), "keyed")
