"""Join of events to the version that was valid at their time, by period bins instead of a range product.

A version is cut into the bins (periods of ``bin_days``) that it reaches and an event falls into one bin, so the join is an
equi-join on entity and bin, with the exact range test on what meets there.  An open end would reach bins without number:
versions are cut at the last bin that an event of the batch needs, found in one small aggregation.

An entity with very many events is spread: its events are dealt into buckets by their content and its versions copied to
each of them.  Entities are counted first, so ordinary ones are not copied.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import BROADCAST_ROWS, _hashable, hot_keys
from tidemark.session import ensure_checkpoint_dir

_BIN, _BUCKET = "__bin", "__bucket"


def _bin(day: Column, bin_days: int) -> Column:
    return F.floor(F.unix_date(F.to_date(day)) / bin_days).cast("long")


def valid_versions(
    events: DataFrame,
    versions: DataFrame,
    entity: str,
    moment: str,
    start: str = "EffectiveStartDate",
    end: str = "EffectiveEndDate",
    columns: Sequence[str] = (),
    bin_days: int = 32,
    latest_start: bool = True,
    max_rows: int = 1_000_000,
) -> DataFrame:
    """Events with ``columns`` of the version of their entity whose days hold theirs; null where there is none.

    Both ends are inclusive days; a null end is open.  Versions that overlap, as ended ones with an open end do, yield the
    one that starts last; with ``latest_start=False`` every one of them.  Events with a null entity or moment meet none and
    are not shuffled by it.  ``columns`` are all others of ``versions`` unless named; none may be a column of ``events``.
    """
    spark = events.sparkSession
    ensure_checkpoint_dir(spark)
    columns = list(columns) or [c for c in versions.columns if c not in {entity, start, end}]
    clash = [c for c in columns if c in events.columns]
    if clash:
        raise ValueError(f"columns of both sides: {clash}")
    matchable = F.col(entity).isNotNull() & F.col(moment).isNotNull()
    rows = events.where(matchable)
    first, last = rows.agg(F.min(_bin(F.col(moment), bin_days)), F.max(_bin(F.col(moment), bin_days))).head()
    side = versions.select(
        F.col(entity).alias("__entity"),
        F.to_date(start).alias("__from"),
        F.coalesce(F.to_date(end), F.to_date(F.lit("9999-12-31"))).alias("__to"),
        F.struct(*columns).alias("__version"),
    ).where(F.col("__entity").isNotNull() & (F.col("__from") <= F.col("__to")))
    low = F.greatest(_bin(F.col("__from"), bin_days), F.lit(first or 0))
    high = F.least(_bin(F.col("__to"), bin_days), F.lit(last or 0))
    # A version outside the events' bins has none.
    bins = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
    side = side.withColumn(_BIN, F.explode(bins))

    counted = hot_keys(rows.select(F.col(entity).alias("__hot")), ["__hot"], max_rows).checkpoint()
    n_hot, most = counted.agg(F.count("*"), F.max("__rows")).head()
    rows = rows.withColumn(_BIN, _bin(F.col(moment), bin_days))
    if n_hot:
        buckets = max(2, ceil(most / max(1, max_rows)))
        listed = counted.select("__hot")
        listed = F.broadcast(listed) if n_hot <= BROADCAST_ROWS else listed
        content = F.pmod(F.xxhash64(*_hashable(events), F.spark_partition_id()), F.lit(buckets)).cast("int")
        # One pass marks each row; what is hot is dealt out, everything else is in bucket 0.
        rows = rows.join(listed, rows[entity] == listed["__hot"], "left")
        rows = rows.withColumn(_BUCKET, F.when(F.col("__hot").isNotNull(), content).otherwise(0)).drop("__hot")
        side = side.join(listed, side["__entity"] == listed["__hot"], "left")
        copies = F.when(F.col("__hot").isNotNull(), F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))
        side = side.withColumn(_BUCKET, F.explode(copies)).drop("__hot")
    else:
        rows, side = rows.withColumn(_BUCKET, F.lit(0)), side.withColumn(_BUCKET, F.lit(0))

    if latest_start:
        joined = _latest(rows, side, entity, moment)
    else:
        day = F.to_date(moment)
        side = side.withColumnRenamed(_BIN, "__vbin").withColumnRenamed(_BUCKET, "__vbucket")
        met = (rows[entity] == side["__entity"]) & (rows[_BIN] == side["__vbin"]) & (rows[_BUCKET] == side["__vbucket"])
        joined = rows.join(side, met & day.between(F.col("__from"), F.col("__to")), "left")
    found = joined.select(*events.columns, *[F.col("__version")[c].alias(c) for c in columns])
    none = events.where(~matchable).select(*events.columns, *[F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in columns])
    return found.unionByName(none)


def _latest(rows: DataFrame, side: DataFrame, entity: str, moment: str) -> DataFrame:
    """Left join to one row per (entity, bin, bucket): its versions, an array.  No event is multiplied and none is grouped.

    The array holds the versions that reach one bin, of which there are at most a few a day.
    """
    packed = side.groupBy("__entity", _BIN, _BUCKET).agg(
        F.sort_array(F.collect_list(F.struct("__from", "__to", "__version")), asc=False).alias("__versions")
    )
    packed = packed.withColumnRenamed(_BIN, "__vbin").withColumnRenamed(_BUCKET, "__vbucket")
    met = (rows[entity] == packed["__entity"]) & (rows[_BIN] == packed["__vbin"]) & (rows[_BUCKET] == packed["__vbucket"])
    day = F.to_date(moment)
    fitting = F.filter("__versions", lambda v: (v["__from"] <= day) & (day <= v["__to"]))
    return rows.join(packed, met, "left").withColumn("__version", F.get(fitting, F.lit(0))["__version"])
