"""High-watermark filters, per-batch watermarks and their two-phase commit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, time, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.temporal import literal_like
from tidemark.spec import LINEAGE_COLUMNS, SOURCE_DATABASE, SOURCE_SERVER, as_utc


def filter_since(
    df: DataFrame, watermark: str, last: datetime, partition_date: str | None = None
) -> DataFrame:
    """Rows strictly after ``last``.

    With ``partition_date`` (a column holding the watermark's date) a second predicate prunes partitions; the raw
    watermark predicate alone cannot.
    """
    fresh = df.where(F.col(watermark) > literal_like(df, watermark, last))
    if partition_date is None:
        return fresh
    return fresh.where(F.col(partition_date) >= F.lit(as_utc(last).date()))


def filter_lookback(
    df: DataFrame, watermark: str, last: datetime, days: int = 2, partition_date: str | None = None
) -> DataFrame:
    """Rows from ``days`` whole days before the date of ``last`` onwards.

    The bound is moved to the literal's side, which keeps the predicate pushable.
    """
    first_day = as_utc(last).date() - timedelta(days=days)
    recent = df.where(F.col(watermark) >= literal_like(df, watermark, datetime.combine(first_day, time())))
    return recent if partition_date is None else recent.where(F.col(partition_date) >= F.lit(first_day))


def max_watermark(df: DataFrame, watermark: str, alias: str = "watermark") -> DataFrame:
    """One row: the largest watermark, null for an empty frame."""
    return df.agg(F.max(watermark).alias(alias))


# Committed watermark by (server, database); None for a source of which nothing is committed yet.
Frontier = Mapping[tuple[str, str], datetime | None]


def filter_frontier(
    df: DataFrame,
    watermark: str,
    frontier: Frontier,
    partition_date: str | None = None,
    lookback_days: int | None = None,
) -> DataFrame:
    """Rows past the watermark of their *own* source; a source without one counts from the beginning.

    One minimum over all sources would re-read what fast sources have delivered long ago and, worse, has no value for a
    source that joins later: its older rows lie before the minimum.  ``frontier`` names every source whose rows ``df`` can
    hold; an empty one filters nothing.  With ``lookback_days`` a source is read from that many days before its watermark.

    Sources of one watermark share a branch of the predicate, so it grows with the number of servers at most.  Every
    branch holds literals of the columns' own types and reaches the scan; while no source is new, partitions are pruned.
    """
    if not frontier:
        return df
    sources: dict[datetime | None, list[tuple[str, str]]] = {}
    for source, last in frontier.items():
        sources.setdefault(None if last is None else as_utc(last), []).append(source)

    def past(last: datetime | None, of: list[tuple[str, str]]) -> Column:
        own = reduce(or_, [(F.col(SOURCE_SERVER) == host) & (F.col(SOURCE_DATABASE) == base) for host, base in of])
        if last is None:
            return own
        if lookback_days is None:
            first_day, fresh = last.date(), F.col(watermark) > literal_like(df, watermark, last)
        else:
            first_day = last.date() - timedelta(days=lookback_days)
            fresh = F.col(watermark) >= literal_like(df, watermark, datetime.combine(first_day, time()))
        pruned = F.lit(True) if partition_date is None else F.col(partition_date) >= F.lit(first_day)
        return own & fresh & pruned

    return df.where(reduce(or_, [past(last, of) for last, of in sources.items()]))


def batch_watermarks(df: DataFrame, watermark: str, sources: Sequence[str] = LINEAGE_COLUMNS) -> DataFrame:
    """Largest watermark per source, cut to whole seconds.

    Rows of the cut-off second are read again next time and absorbed by the upsert.  One pass; each task sends one
    row per source, so a source with most of the rows is no heavier than another.
    """
    stamp = df.schema[watermark].dataType.simpleString()
    cut = F.date_trunc("second", F.max(watermark)).cast(stamp)
    return df.groupBy(*sources).agg(cut.alias("watermark"))


def earliest_watermark(state: DataFrame, group: Sequence[str] = ("table",)) -> DataFrame:
    """The watermark every source of a table has reached."""
    return state.groupBy(*group).agg(F.min("watermark").alias("watermark"))


def commit_watermarks(
    state: DataFrame, staged: DataFrame, identity: Sequence[str] = ("host", "database", "table")
) -> DataFrame:
    """Next state: staged values move a source forward, never back; unknown sources are added."""
    new = staged.select(*identity, F.col("watermark").alias("__staged"))
    return state.join(new, list(identity), "full").select(
        *identity, F.greatest("watermark", "__staged").alias("watermark")
    )

