"""Slowly changing dimension, type 2: from a history of snapshots per entity to versions with effective dates.

The steps chain lazily.  They share one window specification and no step sorts globally, so the whole chain costs one
shuffle and one sort.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import fingerprint
from tidemark.functions.temporal import OPEN_END, timestamps_to_dates
from tidemark.operators.joins import fits_broadcast
from tidemark.operators.ordered import POSITION, SEGMENT, Timeline, split_hot
from tidemark.operators.upsert import dedupe_latest, insert_only, new_rows

# Literals that stored dimensions contain.
NO_REASON = "null"
UNSET_REASON = "<None>"
TERMINATED = "Terminated"
KEY_BASE = 1_000_000


@dataclass(frozen=True)
class VersionSpec:
    """Which columns play which role.

    ``termination`` and ``last_day`` together mark an ended entity; ``start`` joins them where an open end is forced.
    """

    entity: str
    order: str
    tracked: tuple[str, ...]
    filled: tuple[str, ...] = ()
    start: str = "HireDate"
    termination: str = "TerminationDate"
    last_day: str = "LastDayWorked"
    reason: str = "TerminationReason"
    status: str = "Status"
    surrogate: str = "Dim_ID"
    row_hash: str = "RowHashKey"
    effective_start: str = "EffectiveStartDate"
    effective_end: str = "EffectiveEndDate"
    # An entity with more rows than this is processed in segments, since one task has to sort an entity's rows; None
    # promises that no entity gets there.
    max_rows_per_entity: int | None = 5_000_000
    # False if an entity may have several rows of the same ``order``; of these one is kept, the greatest by content.
    unique_order: bool = True

    @property
    def timeline(self) -> Timeline:
        return Timeline(self.entity, self.order)


def _all_set(*columns: str) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def add_row_hash(df: DataFrame, spec: VersionSpec) -> DataFrame:
    """Fingerprint of the tracked attributes; the load date is not part of it."""
    return df.withColumn(spec.row_hash, fingerprint(spec.tracked))


def keep_changes(df: DataFrame, spec: VersionSpec, timeline: Timeline | None = None) -> DataFrame:
    """Keep rows that differ from their predecessor; an entity's first row counts unless it is already terminated."""
    timeline = timeline or spec.timeline
    seen = timeline.with_neighbours(df, previous={"__before": spec.row_hash})
    first_and_active = F.col("__before").isNull() & F.col(spec.termination).isNull()
    changed = F.col("__before") != F.col(spec.row_hash)
    return seen.where(first_and_active | F.coalesce(changed, F.lit(False))).drop("__before")


def drop_after_end(df: DataFrame, spec: VersionSpec, timeline: Timeline | None = None) -> DataFrame:
    """Drop an ended row that directly follows an ended row."""
    timeline = timeline or spec.timeline
    seen = timeline.with_neighbours(
        df, previous={"__before_term": spec.termination, "__before_last": spec.last_day}
    )
    repeated = _all_set("__before_term", "__before_last", spec.termination, spec.last_day)
    return seen.where(~repeated).drop("__before_term", "__before_last")


def fill_forward(df: DataFrame, spec: VersionSpec, timeline: Timeline | None = None) -> DataFrame:
    """Replace nulls in the ``filled`` columns by the entity's last known value."""
    return (timeline or spec.timeline).with_neighbours(df, filled=spec.filled)


def add_effective_dates(df: DataFrame, spec: VersionSpec, timeline: Timeline | None = None) -> DataFrame:
    """A version runs from its load date to the day before the next one, or stays open."""
    timeline = timeline or spec.timeline
    seen = timeline.with_neighbours(df, following={"__after": spec.order})
    end = F.coalesce(F.date_sub(F.to_date("__after"), 1), F.lit(OPEN_END))
    return seen.withColumns({spec.effective_start: F.to_date(spec.order), spec.effective_end: end}).drop("__after")


def open_ended_versions(df: DataFrame, spec: VersionSpec) -> DataFrame:
    """Ended versions keep an open effective end, also when a re-hire follows."""
    ended = _all_set(spec.start, spec.termination, spec.last_day)
    return df.withColumn(spec.effective_end, F.when(ended, F.lit(OPEN_END)).otherwise(F.col(spec.effective_end)))


def settle_status(df: DataFrame, spec: VersionSpec) -> DataFrame:
    """Blank the reason of active rows and the unset marker; terminated rows get the terminated status."""
    active = F.col(spec.termination).isNull()
    return df.withColumns(
        {
            spec.reason: F.when(active | (F.col(spec.reason) == UNSET_REASON), NO_REASON).otherwise(
                F.col(spec.reason)
            ),
            spec.status: F.when(active, F.col(spec.status)).otherwise(TERMINATED),
        }
    )


def surrogate_key(entity: str, day: str) -> Column:
    """Offset entity number followed by the day's eight digits, as one big integer."""
    digits = F.regexp_replace(F.col(day).cast("string"), "-", "")
    return F.concat((F.col(entity) + KEY_BASE).cast("string"), digits).cast("bigint")


def add_surrogate_key(df: DataFrame, spec: VersionSpec) -> DataFrame:
    return df.withColumn(spec.surrogate, surrogate_key(spec.entity, spec.effective_start))


def _versions(df: DataFrame, spec: VersionSpec, timeline: Timeline) -> DataFrame:
    changes = drop_after_end(keep_changes(df, spec, timeline), spec, timeline)
    return dated_versions(timeline.with_neighbours(changes, following={"__after": spec.order}, filled=spec.filled), spec)


def dated_versions(seen: DataFrame, spec: VersionSpec) -> DataFrame:
    """Effective dates, status and key for changes that know the order of the one after them as ``__after``."""
    # Versions have day grain: of several versions of one day the last stays, which keeps what the others filled in.
    lasting = seen.where(F.col("__after").isNull() | (F.to_date("__after") > F.to_date(spec.order)))
    end = F.coalesce(F.date_sub(F.to_date("__after"), 1), F.lit(OPEN_END))
    dated = lasting.withColumns({spec.effective_start: F.to_date(spec.order), spec.effective_end: end}).drop("__after")
    return add_surrogate_key(settle_status(open_ended_versions(dated, spec), spec), spec)


def versions(history: DataFrame, spec: VersionSpec) -> DataFrame:
    """The whole chain: history rows in, dimension versions out.

    Look-ups go by ``order``, so it has to tell an entity's rows apart (see ``unique_order``).  The row hash is taken before
    the fill, so it describes the row as delivered.  An entity has one version a day at most, so that no version ends
    before it starts and surrogate keys are unique.
    """
    if not spec.unique_order:
        history = dedupe_latest(history, [spec.entity, spec.order], [])
    hashed = add_row_hash(history, spec)
    if spec.max_rows_per_entity is None:
        parts = [(hashed, spec.timeline)]
    else:
        parts = split_hot(hashed, spec.timeline, spec.max_rows_per_entity)
    built = [_versions(df, spec, timeline).drop(SEGMENT, POSITION) for df, timeline in parts]
    return reduce(DataFrame.unionByName, built)


def latest_per_day(df: DataFrame, entity: str, order: str) -> DataFrame:
    """Reduce a history to one row per entity and day: the day's last.

    Effective dates have day grain, so this bounds an entity's history by the number of days.  Each task keeps one row
    per entity and day before it shuffles, however many of them one entity has.
    """
    return dedupe_latest(df.withColumn("__day", F.to_date(order)), [entity, "__day"], [order]).drop("__day")


def finish(df: DataFrame, columns: Sequence[str], renames: dict[str, str] | None = None) -> DataFrame:
    """Rename, turn timestamps into dates and put the columns into the dimension's order."""
    return timestamps_to_dates(df.withColumnsRenamed(renames or {})).select(*columns)


def merge_versions(
    target: DataFrame, history: DataFrame, changed: DataFrame, spec: VersionSpec, build=None
) -> DataFrame:
    """Bring a dimension up to date by re-deriving the entities a batch touched.

    ``history`` is the conformed table with all snapshots, ``changed`` the batch.  Re-deriving closes the previously
    open version, keeps a return to earlier values (A, B, A) and places late rows, because it sees what a full build
    sees.  Only rows of touched entities enter the windows.  While the touched entities fit the broadcast bound, neither
    the history nor the dimension is shuffled to find them.
    """
    touched = changed.select(F.col(spec.entity).alias("__touched")).distinct()
    touched = F.broadcast(touched) if fits_broadcast(touched) else touched
    build = build or (lambda df: versions(df, spec))

    def among(df: DataFrame, how: str) -> DataFrame:
        # Rows without an entity are an entity of their own here, as in a full build.
        return df.join(touched, df[spec.entity].eqNullSafe(touched["__touched"]), how)

    rebuilt = build(among(history, "left_semi"))
    return among(target, "left_anti").unionByName(rebuilt.select(*target.columns))


def insert_versions(target: DataFrame, built: DataFrame, spec: VersionSpec) -> DataFrame:
    """Insert-only merge on the row hash, as earlier loads did it: open versions are never closed by later batches."""
    return insert_only(target, built, [spec.row_hash], nullable_keys=False)


def rows_to_append(target: DataFrame, built: DataFrame, spec: VersionSpec) -> DataFrame:
    """What an insert-only load writes: everything while the target holds nothing but its seed row, else new hashes."""
    if len(target.head(2)) < 2:
        return built
    return new_rows(target, built, [spec.row_hash], nullable_keys=False)
