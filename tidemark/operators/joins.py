"""Equi-joins on business keys that stay balanced when keys are null or one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce
from math import ceil
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

# Upper bound on the rows of a frame that is broadcast on purpose.
BROADCAST_ROWS = 1_000_000

_SPREAD = "__null_spread"


def _any_null(df: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(or_, [df[k].isNull() for k in keys])


def _spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add a join column that is constant for real keys and spreads null-key rows by their content.

    The content hash is deterministic, so a re-run task after an executor loss produces the same placement.  It covers
    all columns of ``df``, so project to the needed ones before a join; it is computed for null-key rows only.  A large
    group of identical rows stays in one bucket; AQE splits it like any other skewed partition.
    """
    # Null keys never match, so their rows may go anywhere: a few hash buckets for each shuffle partition.
    buckets = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    content = F.pmod(F.xxhash64(*_hashable(df)), F.lit(buckets)).cast("int")
    return df.withColumn(_SPREAD, F.when(_any_null(df, keys), content + 1).otherwise(_zero(df, keys)))


def _hashable(df: DataFrame) -> list[Column]:
    """Maps cannot be hashed."""
    return [df[f"`{f.name}`"] for f in df.schema.fields if "map<" not in f.dataType.simpleString()]


def fits_broadcast(df: DataFrame) -> bool:
    """Count a key list before it is broadcast; beyond the bound the join shuffles instead."""
    return df.count() <= BROADCAST_ROWS


def _unspread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The other side of :func:`_spread`: zero on every row."""
    return df.withColumn(_SPREAD, _zero(df, keys))


def _zero(df: DataFrame, keys: Sequence[str]) -> Column:
    """Zero, but not a literal: that would be folded into a one-sided condition and leave the join its keys alone."""
    return F.pmod(F.xxhash64(*[df[k] for k in keys]), F.lit(1)).cast("int")


def anti_join(
    df: DataFrame, other: DataFrame, keys: Sequence[str], nullable_keys: bool = True, small: bool = False
) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``other``; rows with a null key always stay.

    ``other`` is reduced to its distinct keys first: the map-side half of that aggregation folds repeated keys before
    the shuffle.  A hot key in ``df`` is split by AQE.  With ``small`` (the caller has checked the size of ``other``) the
    keys are broadcast and ``df`` is not shuffled at all.
    """
    return _existence_join(df, other, keys, "left_anti", nullable_keys, small)


def semi_join(
    df: DataFrame, other: DataFrame, keys: Sequence[str], nullable_keys: bool = True, small: bool = False
) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other``; rows with a null key never do."""
    return _existence_join(df, other, keys, "left_semi", nullable_keys, small)


def _existence_join(
    df: DataFrame, other: DataFrame, keys: Sequence[str], how: str, nullable: bool, small: bool
) -> DataFrame:
    keys = list(keys)
    wanted = other.select(*keys).na.drop(subset=keys).distinct() if nullable else other.select(*keys).distinct()
    if small:
        return df.join(F.broadcast(wanted), keys, how).select(*df.columns)
    if how == "left_semi" and nullable:
        df = df.na.drop(subset=keys)
    # The extra column gives the join a partitioning of its own.  Sharing the one of ``distinct`` would save shuffling a
    # key list, but AQE splits a hot key of the other side only if both sides were shuffled for the join itself.
    spread = _spread(df, keys) if how == "left_anti" and nullable else _unspread(df, keys)
    return spread.join(_unspread(wanted, keys), [*keys, _SPREAD], how).select(*df.columns)


def is_one_of(column: str, values: Collection) -> Column:
    """Membership in a list that may hold null; prunes partitions when ``column`` is a partition column."""
    hit = F.col(column).isin([v for v in values if v is not None])
    return hit | F.col(column).isNull() if None in values else hit


def rows_of_keys(
    df: DataFrame,
    listed: DataFrame,
    keys: Sequence[str],
    partition: str,
    nullable_keys: bool = True,
    small: bool = False,
) -> DataFrame:
    """Semi-join against a partitioned table that reads whole rows only in partitions where a listed key occurs.

    A first pass over the key columns finds those partitions; their number, not that of rows, bounds what is collected.
    """
    hits = semi_join(df.select(*keys, partition), listed, keys, nullable_keys, small).select(partition).distinct()
    values = [row[0] for row in hits.collect()]
    return semi_join(df.where(is_one_of(partition, values)), listed, keys, nullable_keys, small)


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], nullable_keys: bool = True) -> DataFrame:
    """Left outer equi-join for a right side that holds each key a bounded number of times.

    Key columns come from the left; the right's remaining columns follow.  Left rows with a null key are spread.
    A hot key on the left is split by AQE.  When a key may repeat without bound on the right, use
    :func:`left_join_many`.
    """
    keys = list(keys)
    extra = [c for c in right.columns if c not in keys]
    if not nullable_keys:
        return left.join(right, keys, "left").select(*left.columns, *extra)
    spread = _spread(left, keys)
    marked = _unspread(right.na.drop(subset=keys), keys)
    return spread.join(marked, [*keys, _SPREAD], "left").select(*left.columns, *extra)


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame:
    """Keys with more than ``max_rows`` rows; at most ``rows / max_rows`` of them exist.

    Reads the key columns only and counts map-side before it shuffles.
    """
    return df.groupBy(*keys).agg(F.count("*").alias("__rows")).where(F.col("__rows") > max_rows)


def left_join_many(
    left: DataFrame, right: DataFrame, keys: Sequence[str], max_rows: int = 1_000_000, buckets: int | None = None
) -> DataFrame:
    """Left outer equi-join for a right side in which one key may hold a large share of the rows.

    A hot right key cannot be split in an outer join, but its left rows are certain to match, so for hot keys the outer
    join *is* an inner join.  Those rows are joined over ``buckets`` buckets of the right side, with each left row copied
    once per bucket; all other keys take the plain path.  No pair is lost and none is produced twice.  Unless given, the
    number of buckets follows from the counted rows of the hottest key, so that a bucket holds about ``max_rows`` of them.

    The bucket hashes a row's content and the number of the partition it comes from.  A re-run task computes the same
    buckets, and even identical rows meet only if they come from one partition.
    """
    keys = list(keys)
    extra = [c for c in right.columns if c not in keys]
    ensure_checkpoint_dir(right.sparkSession)
    counted = hot_keys(right.na.drop(subset=keys), keys, max_rows).checkpoint()
    n_hot, most = counted.agg(F.count("*"), F.max("__rows")).head()
    if n_hot == 0:
        return left_join(left, right, keys)
    hot, buckets = counted.select(*keys), buckets or max(2, ceil(most / max(1, max_rows)))
    hot = F.broadcast(hot) if n_hot <= BROADCAST_ROWS else hot
    plain = left_join(anti_join_small(left, hot, keys), anti_join_small(right, hot, keys), keys)
    bucket = F.pmod(F.xxhash64(*_hashable(right), F.spark_partition_id()), F.lit(buckets)).cast("int")
    split = right.join(hot, keys, "left_semi").withColumn("__bucket", bucket)
    copies = left.join(hot, keys, "left_semi").withColumn(
        "__bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
    )
    heavy = copies.join(split, [*keys, "__bucket"], "inner").select(*left.columns, *extra)
    return plain.unionByName(heavy)


def anti_join_small(df: DataFrame, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Anti-join against a short key list; null keys stay."""
    return df.join(listed, list(keys), "left_anti").select(*df.columns)
