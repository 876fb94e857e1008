"""Bronze enrichment: hash key, record timestamps, lineage and (for incremental tables) the partition date."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import spec as S
from tidemark.functions.hashing import source_key
from tidemark.functions.temporal import at_zone, instant


def utc_date(df: DataFrame, column: str) -> Column:
    """The UTC date of a column, whatever the session's zone: partition predicates are built from UTC dates as well."""
    if isinstance(df.schema[column].dataType, T.TimestampType):
        return F.date_from_unix_date(F.floor(F.unix_micros(F.col(column)) / F.lit(86_400_000_000)).cast("int"))
    return F.to_date(F.col(column))


def system_columns(
    spec: S.TableSpec, day: Column | None = None, as_of: datetime | Column | None = None, host: Column | None = None
) -> dict[str, Column]:
    """The system columns as expressions, in their fixed order.

    ``day`` is the partition date of an incremental table.

    ``as_of`` pins the record timestamps (replays and tests); without it the query's start time is used.  ``host``
    replaces the spec's constant when one frame already holds several servers.
    """
    created = F.current_timestamp() if as_of is None else instant(as_of) if isinstance(as_of, datetime) else as_of
    server = F.lit(spec.host) if host is None else host
    columns = {S.PARTITION_DATE: day} if spec.incremental else {}
    return columns | {
        S.HASH_KEY: source_key(spec.keys, server),
        S.CREATED_UTC: created,
        S.CREATED_CENTRAL: at_zone(created),
        S.SOURCE_SERVER: server,
        S.SOURCE_DATABASE: F.lit(spec.database),
        S.SOURCE_TABLE: F.lit(spec.qualified_table),
    }


def add_lineage(
    df: DataFrame, spec: S.TableSpec, as_of: datetime | Column | None = None, host: Column | None = None
) -> DataFrame:
    """One projection; no shuffle."""
    day = utc_date(df, spec.watermark) if spec.incremental else None
    return df.withColumns(system_columns(spec, day, as_of, host))


def drop_system_columns(df: DataFrame) -> DataFrame:
    return df.drop(*S.SYSTEM_COLUMNS)
