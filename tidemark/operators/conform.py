"""Bring frames of the same table from several servers to one schema and stack them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def widest_first(frames: Sequence[DataFrame]) -> list[DataFrame]:
    """Stable order by column count, so the widest server decides the leading column order."""
    return sorted(frames, key=lambda df: -len(df.columns))


def all_columns(frames: Sequence[DataFrame]) -> list[str]:
    """Column names over all frames, first seen first; names that differ only in case are one column, as in Spark."""
    seen: dict[str, str] = {}
    for df in frames:
        for name in df.columns:
            seen.setdefault(name.lower(), name)
    return list(seen.values())


def missing_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    have = {c.lower() for c in df.columns}
    return [c for c in columns if c.lower() not in have]


def _family(dtype: T.DataType) -> str:
    """Types that Spark widens into each other; nested types are a family of their own each."""
    if isinstance(dtype, T.NullType):
        return ""
    if isinstance(dtype, T.NumericType):
        return "number"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "moment"
    return dtype.simpleString()


def textual_conflicts(frames: Sequence[DataFrame]) -> set[str]:
    """Columns whose types on two servers have no common type but text."""
    types: dict[str, set[str]] = {}
    for df in frames:
        for f in df.schema.fields:
            types.setdefault(f.name.lower(), set()).add(_family(f.dataType))
    return {name for name, families in types.items() if len(families - {""}) > 1}


def align(df: DataFrame, columns: Sequence[str], as_text: set[str] = frozenset()) -> DataFrame:
    """Project to ``columns`` in order; absent ones become null."""
    absent = set(missing_columns(df, columns))
    return df.select(
        *[
            F.lit(None).alias(c)
            if c in absent
            else (F.col(f"`{c}`").cast("string") if c.lower() in as_text else F.col(f"`{c}`")).alias(c)
            for c in columns
        ]
    )


def conform_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union over the superset of columns.

    Numeric and temporal drift is left to Spark's type widening.  A column that is text on any server, or has types without a
    common one, becomes text everywhere, because the reverse cast could fail on rows it has not seen.  A union adds no shuffle, and filters on
    the result still reach every server's scan.
    """
    if not frames:
        raise ValueError("nothing to union")
    ordered = widest_first(frames)
    columns = all_columns(ordered)
    as_text = textual_conflicts(ordered)
    return reduce(DataFrame.union, [align(df, columns, as_text) for df in ordered])
