"""Neighbour look-ups (previous, next, last non-null) within an entity's ordered rows.

The plain form is a window over the entity: one shuffle and one sort, shared by every look-up in a chain.  It puts an
entity's whole history into one task, which is right while histories are bounded and wrong when one entity may hold a
large share of the table.  For such entities :func:`split_hot` cuts the history into consecutive *segments* of about
``max_rows`` rows.  Windows then run per (entity, segment) and only the look-ups that cross a segment border are patched
from a summary with one row per (entity, segment).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from math import ceil

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.operators.joins import BROADCAST_ROWS, fits_broadcast
from tidemark.session import ensure_checkpoint_dir

SEGMENT, POSITION = "__segment", "__position"
# Hot rows that one task numbers; segments may be far smaller, tasks need not be.
ROWS_PER_TASK = 500_000


@dataclass(frozen=True)
class Timeline:
    """Rows of ``entity`` in the order of ``order``, which must be unique within the entity."""

    entity: str
    order: str
    segment: str | None = None

    @property
    def window(self) -> WindowSpec:
        groups = [self.entity] if self.segment is None else [self.entity, self.segment]
        return Window.partitionBy(*groups).orderBy(self.order)

    def with_neighbours(
        self,
        df: DataFrame,
        previous: Mapping[str, str] | None = None,
        following: Mapping[str, str] | None = None,
        filled: Sequence[str] = (),
    ) -> DataFrame:
        """Add ``previous`` / ``following`` values (new name -> column) and replace ``filled`` columns by their last
        non-null value so far."""
        previous, following = dict(previous or {}), dict(following or {})
        if self.segment is None:
            return self._plain(df, previous, following, filled)
        return self._segmented(df, previous, following, filled)

    def _plain(self, df, previous, following, filled) -> DataFrame:
        w = self.window
        so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns(
            {name: F.lag(c).over(w) for name, c in previous.items()}
            | {name: F.lead(c).over(w) for name, c in following.items()}
            | {c: F.last(c, ignorenulls=True).over(so_far) for c in filled}
        )

    def _segmented(self, df, previous, following, filled) -> DataFrame:
        w = self.window
        so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        carry = self._carry(df, previous, following, filled)
        # A struct tells "no such row in this segment" (null) from "that row's value is null".
        inside = df.withColumns(
            ({"__prev": F.lag(_pack(previous)).over(w)} if previous else {})
            | ({"__next": F.lead(_pack(following)).over(w)} if following else {})
            | {c: F.last(c, ignorenulls=True).over(so_far) for c in filled}
        )
        same = inside[self.entity].eqNullSafe(carry["__entity"]) & (inside[self.segment] == carry["__seg"])
        joined = inside.join(F.broadcast(carry) if fits_broadcast(carry) else carry, same, "left")
        patched = joined.withColumns(
            {name: F.coalesce("__prev", "__prev_carry")[name] for name in previous}
            | {name: F.coalesce("__next", "__next_carry")[name] for name in following}
            | {c: F.coalesce(F.col(c), F.col(f"__fill_{c}")) for c in filled}
        )
        kept = [c for c in df.columns if c not in {*previous, *following}]
        return patched.select(*kept, *previous, *following)

    def _carry(self, df, previous, following, filled) -> DataFrame:
        """What each segment inherits from its neighbours: one row per (entity, segment).

        Segments are cut from a range partitioning of the hot rows, so there are at most (rows / bound + partitions + hot
        entities) of them: few enough to order within an entity; they are counted before they are broadcast.  They are
        stored, since the next look-up of a chain would otherwise compute all earlier ones twice.
        """
        order = F.col(self.order)
        ends: list[Column] = [F.count("*").alias("__n")]
        if previous:
            ends.append(F.max_by(_pack(previous), order).alias("__last"))
        if following:
            ends.append(F.min_by(_pack(following), order).alias("__first"))
        ends += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(f"__end_{c}") for c in filled]
        summary = df.groupBy(F.col(self.entity).alias("__entity"), F.col(self.segment).alias("__seg")).agg(*ends)
        w = Window.partitionBy("__entity").orderBy("__seg")
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        ensure_checkpoint_dir(df.sparkSession)
        carried = summary.select(
            "__entity",
            "__seg",
            *([F.lag("__last").over(w).alias("__prev_carry")] if previous else []),
            *([F.lead("__first").over(w).alias("__next_carry")] if following else []),
            *[F.last(f"__end_{c}", ignorenulls=True).over(before).alias(f"__fill_{c}") for c in filled],
        )
        return carried.checkpoint()


def _pack(columns: Mapping[str, str]) -> Column:
    return F.struct(*[F.col(c).alias(name) for name, c in columns.items()])


def split_hot(df: DataFrame, timeline: Timeline, max_rows: int) -> list[tuple[DataFrame, Timeline]]:
    """Split into rows of ordinary entities and, when there are any, segmented rows of hot ones.

    Counting reads the entity column only and pre-aggregates map-side.  The hot rows are range-partitioned by
    (entity, order), which balances them by quantile whatever their distribution, numbered in that order and cut every
    ``max_rows`` rows; the number of tasks follows the rows, not the bound.  They are checkpointed once so that the
    numbers are stored data rather than something a re-run task could give differently.
    """
    spark = df.sparkSession
    entity = timeline.entity
    ensure_checkpoint_dir(spark)
    counts = df.groupBy(F.col(entity).alias("__hot")).agg(F.count("*").alias("__rows")).where(F.col("__rows") > max_rows)
    counts = counts.checkpoint()
    n_hot, hot_rows = counts.agg(F.count("*"), F.coalesce(F.sum("__rows"), F.lit(0))).head()
    if n_hot == 0:
        return [(df, timeline)]
    listed = counts.select("__hot")
    listed = F.broadcast(listed) if n_hot <= BROADCAST_ROWS else listed
    is_hot = df[entity].eqNullSafe(listed["__hot"])
    cold = df.join(listed, is_hot, "left_anti")
    parts = min(ceil(hot_rows / max_rows), max(spark.sparkContext.defaultParallelism, ceil(hot_rows / ROWS_PER_TASK)))
    # The number of the partition and, in the lower 33 bits, that of the row in it.
    inside = F.col(POSITION).bitwiseAND(F.lit((1 << 33) - 1))
    hot = (
        df.join(listed, is_hot, "left_semi")
        .repartitionByRange(parts, entity, timeline.order)
        .sortWithinPartitions(entity, timeline.order)
        .withColumn(POSITION, F.monotonically_increasing_id())
        .withColumn(SEGMENT, F.col(POSITION) - inside % F.lit(max_rows))
        .checkpoint()
    )
    return [(cold, timeline), (hot, replace(timeline, order=POSITION, segment=SEGMENT))]
