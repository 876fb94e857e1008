"""Time literals, zone shifts and dtype-driven date casts."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.spec import as_utc

CENTRAL = "America/Chicago"
OPEN_END = date(9999, 12, 31)

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _micros(value: datetime) -> int:
    delta = as_utc(value) - _EPOCH
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def instant(value: datetime) -> Column:
    """A ``timestamp`` literal that depends on neither the session's nor the driver machine's zone."""
    return F.timestamp_micros(F.lit(_micros(value)))


def literal_like(df: DataFrame, column: str, value: datetime) -> Column:
    """``value`` as a literal of the column's own type, so that a comparison needs no cast on the column side.

    A cast around the column would keep the predicate away from the Parquet or JDBC scan.
    """
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(as_utc(value).replace(tzinfo=None).isoformat(" ")).cast("timestamp_ntz")
    if isinstance(dtype, T.DateType):
        return F.lit(as_utc(value).date())
    return instant(value)


def at_zone(column: str | Column, zone: str = CENTRAL) -> Column:
    """UTC instant -> wall-clock time of ``zone``, daylight saving included."""
    return F.from_utc_timestamp(column, zone)


def timestamps_to_dates(df: DataFrame) -> DataFrame:
    """Turn every timestamp column into a date and leave the others alone."""
    stamps = (T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[
            F.to_date(df[f"`{f.name}`"]).alias(f.name) if isinstance(f.dataType, stamps) else df[f"`{f.name}`"]
            for f in df.schema.fields
        ]
    )
