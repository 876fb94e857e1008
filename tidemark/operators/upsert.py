"""MERGE semantics as joins: the result is the table's next content, to be written by one of the sinks."""

from __future__ import annotations

from collections.abc import Sequence
from enum import Enum

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import BROADCAST_ROWS, anti_join, semi_join


class OnDuplicate(str, Enum):
    """What to do with several source rows of one key."""

    ERROR = "error"
    LATEST = "latest"
    KEEP = "keep"


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], nullable_keys: bool = False) -> DataFrame:
    """Keep each key's last row by ``order``; the remaining columns break ties so that the result is deterministic.

    ``row_number() = 1`` lets Spark prune every group to one row per map task *before* the shuffle (window group
    limit), so a key with very many copies costs no more than one row per input split.
    """
    comparable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    rest = [c for c in comparable if c not in {*keys, *order}]
    latest = Window.partitionBy(*keys).orderBy(*[F.col(f"`{c}`").desc_nulls_last() for c in [*order, *rest]])
    picked = df.where(_complete(keys)) if nullable_keys else df
    picked = picked.withColumn("__rank", F.row_number().over(latest)).where(F.col("__rank") == 1).drop("__rank")
    return picked.unionByName(df.where(~_complete(keys))) if nullable_keys else picked


def may_repeat(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether rows share a key, or at least its hash.  Counting hashes shuffles a few bytes a row instead of whole rows."""
    hashes = df.groupBy(F.xxhash64(*[F.col(f"`{k}`") for k in keys])).agg(F.count("*").alias("rows"))
    return (hashes.agg(F.max("rows")).head()[0] or 0) > 1


def _complete(keys: Sequence[str]):
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"`{key}`").isNotNull()
    return condition


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count; null keys never match anything and are left out."""
    return df.where(_complete(keys)).groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def resolve_duplicates(
    source: DataFrame,
    keys: Sequence[str],
    on_duplicate: OnDuplicate | str,
    order: Sequence[str] = (),
    nullable_keys: bool = True,
) -> DataFrame:
    policy = OnDuplicate(on_duplicate)
    if policy is OnDuplicate.LATEST:
        return dedupe_latest(source, keys, order, nullable_keys)
    if policy is OnDuplicate.ERROR:
        checked_key_count(source, keys)
    return source


def checked_key_count(source: DataFrame, keys: Sequence[str]) -> int:
    """Number of keys of a batch, an error if one of them repeats.  One aggregation answers both."""
    per_key = source.where(_complete(keys)).groupBy(*keys).agg(F.count("*").alias("rows"))
    count, most = per_key.agg(F.count("*"), F.max("rows")).head()
    if count and most > 1:
        raise ValueError(f"several source rows share the key {duplicate_keys(source, keys).head().asDict()}")
    return count


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    on_duplicate: OnDuplicate | str = OnDuplicate.ERROR,
    order: Sequence[str] = (),
    nullable_keys: bool = True,
) -> DataFrame:
    """Update-all / insert-all on ``keys``: source rows replace target rows of the same key, the rest is inserted.

    Columns new in the source are added, columns the source lacks become null in its rows.  A null in a key never
    matches, so such source rows are inserted again.

    The duplicate check also tells the batch's size: keys within the bound are broadcast and the target is not shuffled.
    Under the other policies Spark decides at run time.
    """
    small = False
    if OnDuplicate(on_duplicate) is OnDuplicate.ERROR:
        small = checked_key_count(source, keys) <= BROADCAST_ROWS
    else:
        source = resolve_duplicates(source, keys, on_duplicate, order, nullable_keys)
    return anti_join(target, source, keys, nullable_keys, small).unionByName(source, allowMissingColumns=True)


def new_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], nullable_keys: bool = True, small: bool = False
) -> DataFrame:
    """Source rows whose key the target does not hold.

    With ``small`` (the caller has checked the source's size) the source's keys are broadcast to the target's scan, so
    that of the target only keys which the source has are shuffled.
    """
    known = semi_join(target.select(*keys), source, keys, nullable_keys, small=True) if small else target
    return anti_join(source, known, keys, nullable_keys)


def insert_only(
    target: DataFrame, source: DataFrame, keys: Sequence[str], nullable_keys: bool = True, small: bool = False
) -> DataFrame:
    """Insert-all without an update branch: target rows always win."""
    return target.unionByName(new_rows(target, source, keys, nullable_keys, small), allowMissingColumns=True)
