"""Run a query on Spark and its SQL on DuckDB and compare schema and rows, order left aside."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(dtype: pa.DataType) -> str:
    if pa.types.is_large_string(dtype) or pa.types.is_string_view(dtype):
        return "string"
    if pa.types.is_timestamp(dtype):
        return "timestamp" if dtype.tz is None else "timestamptz"
    return str(dtype)


def schema_of(table: pa.Table) -> dict[str, str]:
    return {field.name: _plain(field.type) for field in sorted(table.schema, key=lambda f: f.name)}


def rows_of(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    return sorted(zip(*columns), key=repr)


def differences(spark_df: DataFrame, sql: str, connection: duckdb.DuckDBPyConnection) -> list[str]:
    """Empty when both engines agree."""
    ours, theirs = spark_df.toArrow(), connection.sql(sql).to_arrow_table()
    found = []
    if schema_of(ours) != schema_of(theirs):
        a, b = schema_of(ours), schema_of(theirs)
        found.append(f"schema: {[(c, a.get(c), b.get(c)) for c in sorted({*a, *b}) if a.get(c) != b.get(c)]}")
    if ours.num_rows != theirs.num_rows:
        found.append(f"rows: {ours.num_rows} and {theirs.num_rows}")
    elif not found:
        pairs = [(a, b) for a, b in zip(rows_of(ours), rows_of(theirs)) if a != b]
        if pairs:
            found.append(f"{len(pairs)} rows differ, first: {pairs[0]}")
    return found
