"""Fact build: a base table left-joined to an attribute table on their shared business key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import fingerprint, joined_id
from tidemark.operators.joins import fits_broadcast, left_join, left_join_many, rows_of_keys, semi_join
from tidemark.operators.watermarks import filter_since


@dataclass(frozen=True)
class FactSpec:
    """``base`` and ``attributes`` map output names to source columns; ``order`` fixes the output order.

    ``matched`` is an output column holding the attribute side's first key, null where nothing matched.
    ``partitioned`` may repeat in ``base``; it is listed so that sinks can partition by it.
    """

    keys: tuple[str, ...]
    base: Mapping[str, str]
    attributes: Mapping[str, str]
    matched: str = "callId"
    fact_id: str = "Fact_ID"
    hash_key: str = "HashKey"
    order: tuple[str, ...] = ()
    # False when one key may repeat without bound in the attribute table.
    attributes_unique: bool = True
    nullable_keys: bool = True


def build_fact(base: DataFrame, attributes: DataFrame, spec: FactSpec) -> DataFrame:
    """Left join, renames, hash key and id in one pass; only the mapped columns are read."""
    keys = list(spec.keys)
    side = attributes.select(
        *keys, F.col(keys[0]).alias(spec.matched), *[F.col(c).alias(n) for n, c in spec.attributes.items()]
    )
    needed = list(dict.fromkeys([*keys, *spec.base.values()]))
    join = left_join if spec.attributes_unique else left_join_many
    extra = {} if not spec.attributes_unique else {"nullable_keys": spec.nullable_keys}
    joined = join(base.select(*needed), side, keys, **extra)
    fact = joined.select(
        joined_id(keys).alias(spec.fact_id),
        fingerprint(keys).alias(spec.hash_key),
        *[F.col(c).alias(n) for n, c in spec.base.items()],
        spec.matched,
        *spec.attributes,
    )
    return fact.select(*spec.order) if spec.order else fact


def changed_keys(changed: DataFrame, arrived: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of base rows and attribute rows that are new."""
    return changed.select(*keys).unionByName(arrived.select(*keys)).distinct()


def affected_keys(
    base: DataFrame,
    attributes: DataFrame,
    keys: Sequence[str],
    base_watermark: str,
    base_since: datetime,
    attribute_watermark: str,
    attribute_since: datetime,
    partition: str | None = None,
) -> DataFrame:
    """Keys that changed on either side since its watermark; ``partition`` holds the watermarks' date on both sides."""
    changed = filter_since(base, base_watermark, base_since, partition)
    return changed_keys(changed, filter_since(attributes, attribute_watermark, attribute_since, partition), keys)


def refresh_fact(
    base: DataFrame,
    attributes: DataFrame,
    affected: DataFrame,
    spec: FactSpec,
    unkeyed: DataFrame | None = None,
    partition: str | None = None,
) -> DataFrame:
    """Fact rows of the affected keys, built from *all* their base and attribute rows.

    Filtering both sides by their own watermark instead would blank attributes of re-read base rows and never attach
    attributes that arrive after their base row.  While the affected keys fit the broadcast bound, only their rows are
    shuffled, for the final join; beyond it both tables are shuffled once to find them.

    Rows with a null in their key match no list of keys; new ones are handed over as ``unkeyed``.  With ``partition``,
    a column both tables are partitioned by, whole rows are read only from partitions in which an affected key occurs.
    """
    keys = list(spec.keys)
    small = fits_broadcast(affected)

    def of_affected(df: DataFrame) -> DataFrame:
        if partition is None:
            return semi_join(df, affected, keys, spec.nullable_keys, small)
        return rows_of_keys(df, affected, keys, partition, spec.nullable_keys, small)

    rows = of_affected(base)
    if unkeyed is not None:
        rows = rows.unionByName(unkeyed)
    return build_fact(rows, of_affected(attributes), spec)


def without_key(base: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a null in any key column."""
    return base.where(reduce(or_, [F.col(k).isNull() for k in keys]))


def windowed_fact(
    base: DataFrame,
    attributes: DataFrame,
    spec: FactSpec,
    base_watermark: str,
    base_since: datetime,
    attribute_watermark: str,
    attribute_since: datetime,
) -> DataFrame:
    """Both sides filtered by their own watermark before the join, as earlier loads did it; see :func:`refresh_fact`."""
    return build_fact(
        filter_since(base, base_watermark, base_since),
        filter_since(attributes, attribute_watermark, attribute_since),
        spec,
    )
