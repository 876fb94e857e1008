"""Type-2 dimensions brought up to date from carried state: of entities whose rows come in order, only new rows are read.

What a later row is judged by fits one row per entity: the last row's order and hash, the end flags of the last change,
the last known values of filled columns and the start of the last version.  A batch puts this state in front of an entity's
new rows as a row of its own, the *carrier*, and runs the same chain as a full build.  The carrier closes the stored version
before it and yields none itself.  An entity with a row that is not after its state is late: it is built anew from its
whole history, by the same chain and in the same job.  The result equals a full build.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.temporal import OPEN_END
from tidemark.operators.joins import BROADCAST_ROWS
from tidemark.operators.ordered import POSITION, SEGMENT, Timeline, split_hot
from tidemark.operators.scd2 import VersionSpec, _all_set, add_row_hash, dated_versions
from tidemark.operators.upsert import dedupe_latest
from tidemark.session import ensure_checkpoint_dir

_CARRIED, _START, _AFTER, _ENDS, _FILLED = "__carried", "__start", "__after", "__ends", "__filled"


@dataclass(frozen=True)
class Advanced:
    """The dimension's next content and the state that belongs to it."""

    versions: DataFrame
    state: DataFrame


def _check(spec: VersionSpec) -> None:
    if {spec.termination, spec.last_day, spec.entity, spec.order} & set(spec.filled):
        raise ValueError("key, order and end columns cannot be filled where state is carried")


def _prepared(df: DataFrame, spec: VersionSpec) -> DataFrame:
    if not spec.unique_order:
        df = dedupe_latest(df, [spec.entity, spec.order], [])
    return add_row_hash(df, spec).withColumns({_CARRIED: F.lit(False), _START: F.to_date(spec.order)})


def _traced(rows: DataFrame, spec: VersionSpec, timeline: Timeline) -> tuple[DataFrame, DataFrame]:
    """Changes, and those of them that stay after an end, filled, with the next one's order."""
    seen = timeline.with_neighbours(rows, previous={"__before": spec.row_hash})
    first_and_active = F.col("__before").isNull() & F.col(spec.termination).isNull()
    changed = F.coalesce(F.col("__before") != F.col(spec.row_hash), F.lit(False))
    changes = seen.where(F.col(_CARRIED) | first_and_active | changed).drop("__before")
    seen = timeline.with_neighbours(changes, previous={"__before_term": spec.termination, "__before_last": spec.last_day})
    repeated = _all_set("__before_term", "__before_last", spec.termination, spec.last_day)
    staying = seen.where(F.col(_CARRIED) | ~repeated).drop("__before_term", "__before_last")
    return changes, timeline.with_neighbours(staying, following={_AFTER: spec.order}, filled=spec.filled)


def _parts(rows: DataFrame, spec: VersionSpec) -> list[tuple[DataFrame, DataFrame]]:
    if spec.max_rows_per_entity is None:
        return [_traced(rows, spec, spec.timeline)]
    return [_traced(df, spec, timeline) for df, timeline in split_hot(rows, spec.timeline, spec.max_rows_per_entity)]


def _state(rows: DataFrame, parts: list[tuple[DataFrame, DataFrame]], spec: VersionSpec) -> DataFrame:
    """One row per entity, from all its rows, its changes and what stayed of them, in one aggregation."""
    order = F.col(spec.order)
    ends = F.struct(F.col(spec.termination).alias("term"), F.col(spec.last_day).alias("last"))
    filled = F.struct(F.col(_START).alias("start"), *[F.col(c) for c in spec.filled])
    seen = [(rows, F.col(spec.row_hash), None, None)]
    for changes, staying in parts:
        seen += [(changes, None, ends, None), (staying, None, None, filled)]
    types = (F.col(spec.row_hash), ends, filled)
    columns = [
        df.select(spec.entity, order.alias(spec.order), *[
            (F.when(F.lit(False), t) if value is None else value).alias(name)
            for name, value, t in zip((spec.row_hash, _ENDS, _FILLED), values, types)
        ])
        for df, *values in seen
    ]

    def latest(name: str) -> Column:
        return F.max_by(F.col(name), F.when(F.col(name).isNotNull(), order)).alias(name)

    stacked = reduce(DataFrame.unionByName, columns)
    return stacked.groupBy(spec.entity).agg(F.max(order).alias(spec.order), latest(spec.row_hash), latest(_ENDS), latest(_FILLED))


def carried_state(history: DataFrame, spec: VersionSpec) -> DataFrame:
    """State after a full build from ``history``."""
    _check(spec)
    rows = _prepared(history, spec)
    return _state(rows, _parts(rows, spec), spec)


def _carriers(state: DataFrame, like: DataFrame, spec: VersionSpec) -> DataFrame:
    values = {
        spec.entity: F.col(spec.entity),
        spec.order: F.col(spec.order),
        spec.row_hash: F.col(spec.row_hash),
        spec.termination: F.col(_ENDS)["term"],
        spec.last_day: F.col(_ENDS)["last"],
        _CARRIED: F.lit(True),
        _START: F.col(_FILLED)["start"],
    } | {c: F.col(_FILLED)[c] for c in spec.filled}
    return state.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def advance_versions(
    target: DataFrame,
    state: DataFrame,
    history: DataFrame,
    changed: DataFrame,
    spec: VersionSpec,
    layout: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> Advanced:
    """Bring a dimension and its state up to date with ``changed``, the rows that neither has seen.

    Rows that were seen before do no harm: their entities count as late.  ``history`` is read for late entities only, and
    not at all if there is none.  ``layout`` turns versions into rows of ``target``; it keeps the names of the entity, the
    end columns and the effective dates.
    """
    _check(spec)
    spark = target.sparkSession
    ensure_checkpoint_dir(spark)
    new = _prepared(changed, spec)
    entity, order = F.col(spec.entity), F.col(spec.order)
    firsts = new.groupBy(entity.alias("__entity")).agg(F.min(order).alias("__first"), F.count_if(order.isNull()).alias("__unordered"))
    known = firsts.join(state, firsts["__entity"].eqNullSafe(state[spec.entity]), "left")
    has_state = F.col(spec.row_hash).isNotNull()
    behind = has_state & ((F.col("__unordered") > 0) | (F.col("__first") <= order))
    touched = known.select("__entity", F.coalesce(behind, F.lit(False)).alias("__late"), has_state.alias("__known"), *state.columns).checkpoint()
    n, n_late = touched.agg(F.count("*"), F.count_if("__late")).head()
    small = n <= BROADCAST_ROWS

    def of(df: DataFrame, late: bool) -> DataFrame:
        listed = touched.where(F.col("__late") == late).select("__entity")
        return df.join(F.broadcast(listed) if small else listed, df[spec.entity].eqNullSafe(listed["__entity"]), "left_semi")

    rows = of(new, False) if n_late else new
    rows = rows.unionByName(_carriers(touched.where(~F.col("__late") & F.col("__known")), new, spec))
    if n_late:
        rows = rows.unionByName(of(_prepared(history, spec), True).select(*rows.columns))
    rows = rows.checkpoint()
    parts = _parts(rows, spec)
    staying = reduce(DataFrame.unionByName, [df.drop(SEGMENT, POSITION) for _, df in parts])
    built = dated_versions(staying.where(~F.col(_CARRIED)), spec).drop(_CARRIED, _START)

    # What becomes of stored versions: late entities' go, the last one of the others ends where a new one starts.
    next_day = staying.where(F.col(_CARRIED)).select(
        entity.alias("__entity"), F.col(_START).alias("__last_start"), F.to_date(_AFTER).alias("__next"), F.lit(False).alias("__gone")
    )
    late = touched.where("__late").select("__entity", F.lit(None).cast("date").alias("__last_start"), F.lit(None).cast("date").alias("__next"), F.lit(True).alias("__gone"))
    fate = next_day.unionByName(late)
    joined = target.join(F.broadcast(fate) if small else fate, target[spec.entity].eqNullSafe(fate["__entity"]), "left")
    is_last = F.coalesce((F.col(spec.effective_start) == F.col("__last_start")) & F.col("__next").isNotNull(), F.lit(False))
    replaced = is_last & (F.col("__next") <= F.col("__last_start"))
    ended = _all_set(spec.start, spec.termination, spec.last_day)
    end = F.when(is_last & ~ended, F.date_sub("__next", 1)).when(is_last, F.lit(OPEN_END)).otherwise(F.col(spec.effective_end))
    kept = joined.where(~F.coalesce("__gone", F.lit(False)) & ~F.coalesce(replaced, F.lit(False))).withColumn(spec.effective_end, end)
    versions = kept.select(*target.columns).unionByName(layout(built).select(*target.columns))

    listed = touched.select("__entity")
    idle = state.join(F.broadcast(listed) if small else listed, state[spec.entity].eqNullSafe(listed["__entity"]), "left_anti")
    return Advanced(versions, idle.unionByName(_state(rows, parts, spec)))
