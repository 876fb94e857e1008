"""Landing -> bronze -> silver -> gold over one storage root.

Order of effects, so that a crash at any point is repaired by running again: data first, then the ledger entry or the
staged watermark, and the committed watermark last.  Every data write is an overwrite of a batch or an idempotent upsert.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from enum import Enum
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import spec as S
from tidemark.operators import measures, runlog
from tidemark.operators.carry import advance_versions, carried_state
from tidemark.operators.conform import conform_union
from tidemark.operators.enrich import add_lineage
from tidemark.operators.runlog import from_micros
from tidemark.operators.scd2 import VersionSpec, merge_versions, rows_to_append
from tidemark.operators.upsert import OnDuplicate, dedupe_latest, may_repeat
from tidemark.operators.watermarks import (
    Frontier, commit_watermarks, earliest_watermark, filter_frontier, filter_since, max_watermark,
)
from tidemark.plans.fact import FactSpec, build_fact, changed_keys, refresh_fact, without_key
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import landing, paths, tables
from tidemark.sources.rows import local_frame
from tidemark.spec import TableSpec

log = logging.getLogger(__name__)

STATE_DDL = "host string, database string, table string, watermark timestamp"
STATE_KEYS = ("host", "database", "table")
STATE_OF = "__dimension"
PER_SOURCE = ("landing", "bronze", "quarantine")
#: Batch that a row kept apart was landed in; its folder is named after the newest batch of its load.
LANDED_IN = "__landed_batch"
# A partition that silver rewrote; one whose value was not told apart (a new table) stands for all.
JOURNAL_DDL = "partition string, everything boolean"


class OnError(str, Enum):
    """What a failing source does to the other sources of its table."""

    ISOLATE = "isolate"
    ABORT = "abort"


@dataclass(frozen=True)
class Loaded:
    """What one step did for one source."""

    spec: TableSpec
    rows: int
    last: datetime | None = None
    status: str = runlog.SUCCESS
    error: Exception | None = None


@dataclass
class Medallion:
    spark: SparkSession
    root: str
    clock: Callable[[], datetime] = field(default=lambda: datetime.now(timezone.utc))
    #: Sources that a step loads at a time, each in a scheduler pool of its own.
    parallel: int = 8
    #: Landing and bronze write down nulls per column as well, so that they can be compared without being read again.
    measured: bool = False
    #: Processed batches that bronze leaves in landing, and versions of a snapshot that are kept; None for all.
    keep_batches: int | None = None
    keep_versions: int | None = None
    # The run log and the ledger are appended to by one load at a time: Spark's commits into one folder exclude each other.
    _appending: threading.Lock = field(default_factory=threading.Lock, repr=False, compare=False)

    # --- locations ---------------------------------------------------------------------------------------------------

    def path(self, layer: str, spec: TableSpec | str) -> str:
        """Landing and bronze are kept per server, later layers per table."""
        name = spec if isinstance(spec, str) else spec.relative_path if layer in PER_SOURCE else spec.table
        return f"{self.root}/{layer}/{name}"

    @property
    def ledger_path(self) -> str:
        return f"{self.root}/state/ledger"

    @property
    def log_path(self) -> str:
        return f"{self.root}/state/run_log"

    @property
    def measures_path(self) -> str:
        return f"{self.root}/state/measures"

    def state_path(self, table: str = "", staged: bool = False) -> str:
        """Each table has state of its own, so that flows of several tables do not overwrite each other's."""
        return f"{self.root}/state/{'staged' if staged else 'watermarks'}/{table}".rstrip("/")

    # --- state -------------------------------------------------------------------------------------------------------

    def state(self, staged: bool = False, names: Sequence[str] | None = None) -> DataFrame:
        """Watermarks of the named tables, or of all; one small snapshot each."""
        if names is None:
            names = paths.subfolders(self.spark, self.state_path(staged=staged))
        found = [self.state_path(name, staged) for name in names]
        kept = [tables.read_snapshot(self.spark, p) for p in found if tables.snapshot_exists(self.spark, p)]
        return reduce(DataFrame.unionByName, kept) if kept else local_frame(self.spark, [], STATE_DDL)

    def at_watermark(self, spec: TableSpec) -> TableSpec:
        """The spec, moved to the committed watermark of its source if there is one."""
        row = (
            self.state(names=[spec.table])
            .where((F.col("host") == spec.host) & (F.col("database") == spec.database) & (F.col("table") == spec.table))
            .select(F.unix_micros("watermark"))
            .head()
        )
        return spec if row is None or row[0] is None else spec.since(from_micros(row[0]))

    def earliest(self, table: str) -> datetime:
        """Smallest committed watermark over a table's servers; an unknown table is an error, not a value."""
        row = earliest_watermark(self.state(names=[table])).select(F.unix_micros("watermark")).head()
        if row is None or row[0] is None:
            raise LookupError(f"no committed watermark for {table}")
        return from_micros(row[0])

    def frontier(self, table: str) -> Frontier:
        """How far each source of a table is committed; None for sources that silver has staged for the first time."""
        known = [
            (row["host"], row["database"], row["micros"], committed)
            for committed, state in ((False, self.state(True, [table])), (True, self.state(names=[table])))
            for row in state.select("host", "database", F.unix_micros("watermark").alias("micros")).collect()
        ]
        staged = {(host, base): None for host, base, *_ in known}
        return staged | {(host, base): from_micros(m) for host, base, m, committed in known if committed and m is not None}

    def _recent(self, df: DataFrame, spec: TableSpec, lookback_days: int | None = None) -> DataFrame:
        """Silver rows that no committed gold load has seen; only partitions that were rewritten since then are opened.

        A look-back reads rows again on purpose, from all partitions of its days.
        """
        recent = filter_frontier(df, spec.watermark, self.frontier(spec.table), S.PARTITION_DATE, lookback_days)
        changed = None if lookback_days is not None else self.rewritten(spec.table)
        if changed is None:
            return recent
        dtype = df.schema[S.PARTITION_DATE].dataType
        values = [F.lit(v).cast(dtype) for v in changed if v is not None]
        hit = F.col(S.PARTITION_DATE).isin(values) if values else F.lit(False)
        return recent.where(hit | F.col(S.PARTITION_DATE).isNull() if None in changed else hit)

    def journal_path(self, table: str) -> str:
        return f"{self.root}/state/rewritten/{table}"

    def _journal(self, table: str, rewritten: Sequence | None) -> None:
        """Remember which partitions a load rewrote, until the table is committed; None for all of them."""
        path = self.journal_path(table)
        rows = [(None, True)] if rewritten is None else [(None if v is None else str(v), False) for v in rewritten]
        new = local_frame(self.spark, rows, JOURNAL_DDL)
        if tables.snapshot_exists(self.spark, path):
            new = tables.read_snapshot(self.spark, path).union(new).distinct()
        tables.write_snapshot(new.coalesce(1), path)
        tables.drop_old_snapshots(self.spark, path)

    def rewritten(self, table: str) -> list[str | None] | None:
        """Partitions of silver that changed since the table's last commit; None if that is not known or is all of them."""
        path = self.journal_path(table)
        if not tables.snapshot_exists(self.spark, path):
            return None
        rows = tables.read_snapshot(self.spark, path).collect()  # bounded by the number of partitions
        return None if any(r["everything"] for r in rows) else sorted((r["partition"] for r in rows), key=lambda v: (v is not None, v))

    def stage(self, loads: Iterable[Loaded]) -> None:
        """Remember how far each source got; whole seconds, so the last second is read again."""
        rows = [
            (x.spec.host, x.spec.database, x.spec.table, S.as_utc(x.last).replace(microsecond=0))
            for x in loads
            if x.last is not None
        ]
        for table in sorted({row[2] for row in rows}):
            new = local_frame(self.spark, [row for row in rows if row[2] == table], STATE_DDL)
            staged = commit_watermarks(self.state(True, [table]), new, STATE_KEYS)
            tables.write_snapshot(staged.coalesce(1), self.state_path(table, staged=True))

    def commit(self, names: Sequence[str] | None = None) -> DataFrame:
        """Make staged watermarks of the named tables the starting point of their next run.

        Call it after the last layer that reads them has succeeded.  Without names all tables are committed, which is
        right only where one flow feeds them all.
        """
        for table in paths.subfolders(self.spark, self.state_path(staged=True)) if names is None else names:
            merged = commit_watermarks(self.state(names=[table]), self.state(True, [table]), STATE_KEYS)
            tables.write_snapshot(merged.coalesce(1), self.state_path(table))
            tables.drop_old_snapshots(self.spark, self.state_path(table, staged=True))
            tables.drop_old_snapshots(self.spark, self.state_path(table))
            if tables.snapshot_exists(self.spark, self.journal_path(table)):
                tables.write_snapshot(local_frame(self.spark, [], JOURNAL_DDL).coalesce(1), self.journal_path(table))
                tables.drop_old_snapshots(self.spark, self.journal_path(table))
        return self.state()

    # --- landing -----------------------------------------------------------------------------------------------------

    def land(self, spec: TableSpec, source: DataFrame, moment: datetime | None = None) -> Loaded:
        """Write one pull as a batch.  Count and largest watermark come from the write job: one pass over the source."""
        start = self.clock()
        metrics = measures.LoadMetrics(spec.watermark if spec.incremental else None, source.columns if self.measured else ())
        base, batch = self.path("landing", spec), landing.batch_name(spec.table, moment or start)
        path = landing.land(metrics.attach(source), base, batch)
        self._measure(metrics, "landing", spec, [batch])
        done = Loaded(spec, metrics.rows, metrics.last, runlog.status_of(metrics.rows))
        self._log(done, "landing", path, start)
        return done

    def land_all(
        self, specs: Sequence[TableSpec], read: Callable[[TableSpec], DataFrame], on_error: OnError = OnError.ISOLATE
    ) -> list[Loaded]:
        """Pull every source from its committed watermark."""

        def pull(spec: TableSpec) -> Loaded:
            current = self.at_watermark(spec)
            return self.land(current, read(current))

        return self._each(specs, pull, "landing", on_error)

    # --- bronze ------------------------------------------------------------------------------------------------------

    def pending(self, spec: TableSpec) -> list[str]:
        """Names of landed batches not yet in bronze, oldest first."""
        return self._batches(spec)[1]

    def _batches(self, spec: TableSpec) -> tuple[list[str], list[str]]:
        """Processed and pending batches, oldest first.  Processed ones, however many, cost one listing together."""
        base = self.path("landing", spec)
        names = landing.batch_folders(self.spark, base)
        if not names:
            return [], []
        batches = local_frame(self.spark, [(spec.relative_path, n) for n in names], f"source string, {landing.BATCH} string")
        todo = landing.pending_batches(batches, landing.read_ledger(self.spark, self.ledger_path))
        waiting = {row[landing.BATCH] for row in todo.collect()}
        pending = landing.committed(self.spark, base, [n for n in names if n in waiting])
        return [n for n in names if n not in waiting], pending

    def bronze(self, spec: TableSpec, as_of: datetime | None = None) -> Loaded:
        """Enrich all pending batches and bring them into the server's bronze table.

        Incremental tables are upserted by hash key, the newest batch winning.  Full tables are replaced by their newest
        batch; older pending ones are superseded.

        Rows that break a rule of the spec are kept apart, under ``quarantine`` and per batch, with the names of the rules
        they break; they count neither as inserted nor as missing.  How many break which rule, and with ``measured`` the
        nulls per column, come from the job that reads the batches.
        """
        start = self.clock()
        processed, pending = self._batches(spec)
        path = self.path("bronze", spec)
        if not pending:
            return Loaded(spec, 0, None, runlog.EMPTY)
        base = self.path("landing", spec)
        try:
            if spec.incremental:
                rows, last = self._bronze_incremental(spec, base, pending, path, as_of or start)
            else:
                rows, last = self._bronze_full(spec, base, pending[-1], path, as_of or start)
        except Exception:
            self._record(spec, pending, "failed")
            raise
        self._record(spec, pending, "processed")
        done = Loaded(spec, rows, last, runlog.status_of(rows))
        self._log(done, "bronze", path, start)
        if self.keep_batches is not None:
            self._drop_batches(spec, processed + pending, self.keep_batches)
        if not spec.incremental:
            self._drop_versions(path)
        return done

    def _checked(self, spec: TableSpec, landed: DataFrame) -> tuple[DataFrame, measures.LoadMetrics]:
        """Landed rows with the rules they break, if there are any rules, and what counts them as they are read."""
        rules = dict(spec.rules)
        columns = [c for c in landed.columns if c != landing.BATCH] if self.measured else []
        metrics = measures.LoadMetrics(spec.watermark if spec.incremental else None, columns, rules)
        return (measures.with_broken_rules(landed, rules) if rules else landed), metrics

    def _set_apart(self, spec: TableSpec, metrics: measures.LoadMetrics, checked: DataFrame, batches: Sequence[str]) -> int:
        """Write rows that break rules into a folder of their load, anew if it is repeated; the number of rows left."""
        if (spec.rules or self.measured) and not metrics.observed:
            metrics.measure(checked)  # nothing was left of the rows, so the plan that counted them was cut short
        self._measure(metrics, "bronze", spec, batches)
        base = self.path("quarantine", spec)
        for batch in batches if spec.rules else ():
            paths.delete(self.spark, f"{base}/{landing.BATCH}={batch}")  # of a load of these batches that was interrupted
        if metrics.rejected:
            landing.land(measures.unsound(checked).withColumnRenamed(landing.BATCH, LANDED_IN), base, batches[-1])
        return metrics.rows - metrics.rejected

    def read_quarantine(self, spec: TableSpec) -> DataFrame | None:
        """Rows of a source that broke rules, with the rules' names and their batch; None if there were never any."""
        base = self.path("quarantine", spec)
        loads = landing.landed_batches(self.spark, base)
        if not loads:
            return None
        return landing.read_batches(self.spark, base, loads).drop(landing.BATCH).withColumnRenamed(LANDED_IN, landing.BATCH)

    def _bronze_incremental(self, spec, base, pending, path, as_of) -> tuple[int, datetime | None]:
        # The metrics are of the job that writes: whole rows are read once, but for those that break rules.
        checked, metrics = self._checked(spec, landing.read_batches(self.spark, base, pending))
        enrich = lambda df: add_lineage(measures.sound(df) if spec.rules else df, spec, as_of)
        unique = enrich(metrics.attach(checked))
        # Whole rows are shuffled and sorted by key only where a key repeats at all.
        if may_repeat(enrich(checked), [S.HASH_KEY]):
            unique = dedupe_latest(unique, [S.HASH_KEY], [landing.BATCH, spec.watermark])
        unique = unique.drop(landing.BATCH)
        tables.upsert_partitions(
            self.spark, path, unique, [S.HASH_KEY], S.PARTITION_DATE,
            stable_partition=spec.stable_partition, on_duplicate=OnDuplicate.KEEP,
        )
        return self._set_apart(spec, metrics, checked, pending), metrics.last

    def _bronze_full(self, spec, base, newest, path, as_of) -> tuple[int, None]:
        checked, metrics = self._checked(spec, landing.read_batches(self.spark, base, [newest]))
        landed = metrics.attach(checked)
        rows = (measures.sound(landed) if spec.rules else landed).drop(landing.BATCH)
        tables.write_snapshot(add_lineage(rows, spec, as_of), path)
        return self._set_apart(spec, metrics, checked, [newest]), None

    def bronze_all(
        self, specs: Sequence[TableSpec], as_of: datetime | None = None, on_error: OnError = OnError.ABORT
    ) -> list[Loaded]:
        return self._each(specs, lambda spec: self.bronze(spec, as_of), "bronze", on_error)

    def read_bronze(self, spec: TableSpec) -> DataFrame:
        return tables.read_table(self.spark, self.path("bronze", spec), "partitioned" if spec.incremental else "snapshot")

    # --- silver ------------------------------------------------------------------------------------------------------

    def gather(self, specs: Sequence[TableSpec]) -> DataFrame | None:
        """Bronze rows past each source's committed watermark (all rows for full loads), conformed and stacked.

        A source without a bronze table yet contributes nothing.
        """
        frames = [frame for frame in map(self._fresh, specs) if frame is not None]
        return conform_union(frames) if frames else None

    def _fresh(self, spec: TableSpec) -> DataFrame | None:
        path = self.path("bronze", spec)
        if not spec.incremental:
            return self.read_bronze(spec) if tables.snapshot_exists(self.spark, path) else None
        if not paths.has_data(self.spark, path):
            return None
        since = self.at_watermark(spec).last_loaded
        return filter_since(self.read_bronze(spec), spec.watermark, since, S.PARTITION_DATE)

    def silver(self, specs: Sequence[TableSpec], on_error: OnError = OnError.ISOLATE) -> list[Loaded]:
        """One silver table from all its servers; watermarks are staged only after the write succeeded.

        A server whose rows cannot be read is left out and logged as failed, beside the row of the others.
        """
        start = self.clock()
        try:
            return self._silver(specs, start, on_error)
        except Exception as error:
            failed = Loaded(specs[0], 0, None, runlog.FAILED, error)
            self._log(failed, "silver", self.path("silver", specs[0]), start, consolidated=True)
            raise

    def silver_all(self, specs: Sequence[TableSpec], on_error: OnError = OnError.ISOLATE) -> dict[str, list[Loaded]]:
        """Silver of several tables side by side; a table that fails leaves the others alone unless ``on_error`` says so."""
        by_table: dict[str, list[TableSpec]] = {}
        for spec in specs:
            by_table.setdefault(spec.table, []).append(spec)
        run = lambda name: self.silver(by_table[name], on_error)
        done = self._side_by_side(list(by_table), run, stop_at_error=on_error is OnError.ABORT)
        errors = [x for x in done if isinstance(x, Exception)]
        if errors and on_error is OnError.ABORT:
            raise errors[0]
        failed = lambda name, error: [Loaded(by_table[name][0], 0, None, runlog.FAILED, error)]
        return {n: failed(n, x) if isinstance(x, Exception) else x for n, x in zip(by_table, done) if x is not None}

    def _silver(self, specs: Sequence[TableSpec], start: datetime, on_error: OnError) -> list[Loaded]:
        first = specs[0]
        path = self.path("silver", first)
        loads, frames = [], []

        def measured(spec: TableSpec) -> tuple[DataFrame | None, Loaded]:
            frame = self._fresh(spec)
            return frame, self._measured(spec, frame)

        found = self._side_by_side(list(specs), measured, stop_at_error=on_error is OnError.ABORT)
        for spec, result in zip(specs, found):
            if isinstance(result, Exception):
                if on_error is OnError.ABORT:
                    raise result
                log.error("silver cannot read %s", spec.relative_path, exc_info=result)
                loads.append(Loaded(spec, 0, None, runlog.FAILED, result))
            elif result is not None:
                loads.append(result[1])
                frames += [result[0]] if result[1].rows else []
        failed = [x for x in loads if x.status == runlog.FAILED]
        if failed:
            self._log(Loaded(first, 0, None, runlog.FAILED, failed[0].error), "silver", path, start, consolidated=True)
        if not frames:
            return loads
        batch = conform_union(frames)
        if first.incremental:
            # Hash keys hold the server, and each server's bronze table is unique.
            exists = paths.has_data(self.spark, path)
            done = tables.upsert_partitions(
                self.spark, path, batch, [S.HASH_KEY], S.PARTITION_DATE,
                stable_partition=first.stable_partition, on_duplicate=OnDuplicate.KEEP,
            )
            # Before the watermarks: a crash in between repeats the load, and with it this entry.
            self._journal(first.table, done if exists else None)
            self.stage(loads)
        else:
            tables.write_snapshot(batch, path)
            self._drop_versions(path)
            self.stage([Loaded(x.spec, x.rows, start, x.status) for x in loads if x.rows])
        total = sum(x.rows for x in loads)
        last = max((x.last for x in loads if x.last is not None), default=None)
        self._log(Loaded(first, total, last), "silver", path, start, consolidated=True)
        return loads

    def _measured(self, spec: TableSpec, frame: DataFrame | None) -> Loaded:
        """Rows and largest watermark of one server: one pass over one column."""
        if frame is None:
            return Loaded(spec, 0, None, runlog.EMPTY)
        mark = F.unix_micros(F.max(F.col(spec.watermark).cast("timestamp"))) if spec.incremental else F.lit(None)
        rows, last = frame.agg(F.count("*"), mark).head()
        return Loaded(spec, rows, None if last is None else from_micros(last), runlog.status_of(rows))

    def read_silver(self, spec: TableSpec) -> DataFrame:
        return tables.read_table(self.spark, self.path("silver", spec), "partitioned" if spec.incremental else "snapshot")

    # --- gold --------------------------------------------------------------------------------------------------------

    def fact(
        self,
        name: str,
        base: TableSpec,
        attributes: TableSpec,
        fact: FactSpec,
        merge_keys: Sequence[str],
        partition: str,
        on_duplicate: OnDuplicate | str = OnDuplicate.ERROR,
        windowed: bool = False,
    ) -> None:
        """Create the fact or bring it up to date with what changed in silver on either side since the last commit.

        Each source counts from its own committed watermark, so a server that joins late, or whose first load failed,
        brings all its rows, however old.

        ``windowed`` filters each side by its own watermark before the join, as stored loads do it: attributes that
        arrive later than their base row are then not attached.
        """
        start = self.clock()
        path = self.path("gold", name)
        rows, details = self.read_silver(base), self.read_silver(attributes)
        if not paths.has_data(self.spark, path):
            done = tables.upsert_partitions(
                self.spark, path, build_fact(rows, details, fact), merge_keys, partition, on_duplicate=on_duplicate
            )
            last = self._last(rows, base)
        else:
            recent, late = self._recent(rows, base), self._recent(details, attributes)
            if windowed:
                fresh = build_fact(recent, late, fact)
            else:
                # The key list feeds both sides' partition search and both semi-joins: it is stored once.
                ensure_checkpoint_dir(self.spark)
                keys = changed_keys(recent, late, fact.keys).checkpoint()
                fresh = refresh_fact(rows, details, keys, fact, without_key(recent, fact.keys), S.PARTITION_DATE)
            done = tables.upsert_partitions(
                self.spark, path, fresh, merge_keys, partition, fact.nullable_keys, on_duplicate=on_duplicate
            )
            last = self._last(recent, base)
        self._log_gold(name, path, base, start, done.rows, last)

    def _last(self, rows: DataFrame, spec: TableSpec) -> datetime | None:
        largest = max_watermark(rows, spec.watermark)
        value = largest.select(F.unix_micros(F.col("watermark").cast("timestamp"))).head()[0]
        return None if value is None else from_micros(value)

    def dimension(
        self,
        name: str,
        source: TableSpec,
        versions: VersionSpec,
        build: Callable[[DataFrame], DataFrame],
        seed: DataFrame | None = None,
        lookback_days: int = 2,
        insert_only: bool = False,
        layout: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        """Create the dimension or re-derive the entities with rows since the committed watermark, less a look-back.

        ``build`` turns history rows into dimension rows; ``seed`` rows are put into a new dimension.  ``insert_only``
        adds row hashes that are new and closes nothing, as stored loads do it.  The dimension's own watermark, its largest
        effective start, is staged under its name.

        With ``layout``, which turns versions into dimension rows, the dimension is advanced from carried state: only new
        rows are read, but for entities whose rows come late (see :mod:`tidemark.operators.carry`).  Rows behind their
        source's committed watermark do not reach silver, so there is nothing to look back for.  The state names the
        version of the dimension it belongs to; where it belongs to another, after a crash between the two writes, both are
        built anew.
        """
        start = self.clock()
        path = self.path("gold", name)
        history = self.read_silver(source)
        state = self._carried(path) if layout else None
        if layout and state is not None:
            target, changed = tables.read_snapshot(self.spark, path), self._recent(history, source)
            done = advance_versions(target, state, history, changed, versions, layout)
            self._keep_carried(path, tables.write_snapshot(done.versions, path), done.state)
        elif layout or not tables.snapshot_exists(self.spark, path):
            built = build(history)
            folder = tables.write_snapshot(built if seed is None else seed.unionByName(built), path)
            if layout:
                self._keep_carried(path, folder, carried_state(history, versions))
        else:
            changed = self._recent(history, source, lookback_days)
            target = tables.read_snapshot(self.spark, path)
            if insert_only:
                built = rows_to_append(target, build(changed), versions)
                merged = target.unionByName(built.select(*target.columns))
            else:
                merged = merge_versions(target, history, changed, versions, build)
            tables.write_snapshot(merged, path)
        written = tables.read_snapshot(self.spark, path)
        mark = F.unix_date(F.max(versions.effective_start)) if versions.effective_start in written.columns else F.lit(None)
        rows, day = written.agg(F.count("*"), mark).head()
        last = None if day is None else from_micros(day * 86_400_000_000)
        self._drop_versions(path)
        self._drop_versions(f"{path}.carried")
        self.stage([Loaded(replace(source, host="", table=name), rows, last)])
        self._log_gold(name, path, source, start, rows, last)

    def _carried(self, path: str) -> DataFrame | None:
        """State of the dimension's current version, if there is one."""
        current, kept = tables.current_snapshot(self.spark, path), f"{path}.carried"
        if current is None or not tables.snapshot_exists(self.spark, kept):
            return None
        state = tables.read_snapshot(self.spark, kept)
        known = state.select(STATE_OF).head()
        return state.drop(STATE_OF) if known and known[0] == current else None

    def _keep_carried(self, path: str, folder: str, state: DataFrame) -> None:
        tables.write_snapshot(state.withColumn(STATE_OF, F.lit(folder)), f"{path}.carried")

    def _log_gold(
        self, name: str, path: str, source: TableSpec, start: datetime, rows: int, last: datetime | None
    ) -> None:
        """Gold tables belong to no server; the row says what the load moved and how far it got."""
        done = Loaded(replace(source, table=name), rows, last, runlog.status_of(rows))
        self._log(done, "gold", path, start, consolidated=True)

    def purge(self, specs: Sequence[TableSpec], keep: int = 1) -> list[str]:
        """Delete processed landing batches, but for the newest ``keep`` of each source, and unreferenced snapshots."""
        gone = []
        for spec in specs:
            gone += self._drop_batches(spec, self._batches(spec)[0], keep)
            if not spec.incremental:
                for layer in ("bronze", "silver", "gold"):
                    gone += tables.drop_old_snapshots(self.spark, self.path(layer, spec))
        return gone

    def _drop_batches(self, spec: TableSpec, processed: Sequence[str], keep: int) -> list[str]:
        folders = [f"{self.path('landing', spec)}/{landing.BATCH}={batch}" for batch in sorted(processed)]
        old = folders[: max(0, len(folders) - keep)]
        for folder in old:
            paths.delete(self.spark, folder)
        return old

    def _drop_versions(self, path: str) -> None:
        if self.keep_versions is not None:
            tables.drop_old_snapshots(self.spark, path, self.keep_versions)

    def compact_logs(self, more_than: int = 100) -> dict[str, int]:
        """Fold the small files that loads append to the run log, the ledger and the measures; files folded per log.

        Between loads, since a reader may miss what moves meanwhile.
        """
        logs = {
            self.log_path: runlog.RUN_LOG_SCHEMA, self.ledger_path: landing.LEDGER_SCHEMA,
            self.measures_path: measures.MEASURES_DDL,
        }
        with self._appending:
            return {path: tables.compact(self.spark, path, schema, more_than) for path, schema in logs.items()}

    def promote(self, names: Iterable[str]) -> None:
        """Copy full-load tables from silver to gold as they are."""
        for name in names:
            tables.promote(self.spark, self.path("silver", name), self.path("gold", name))

    def register(self, layer: str, name: str) -> None:
        tables.register_table(self.spark, name.lower(), self.path(layer, name), layer)

    # --- shared ------------------------------------------------------------------------------------------------------

    def _side_by_side(self, items: Sequence, step: Callable, stop_at_error: bool = False) -> list:
        """``step`` of every item, at most ``parallel`` at a time; an item's result, its exception, or None if not begun.

        Slow sources keep the cluster busy with each other's work.  Every item runs in a pool of its own, so with the FAIR
        scheduler a large one does not hold up small ones.  After an error nothing new begins if ``stop_at_error``.
        """
        failed = threading.Event()
        context = self.spark.sparkContext

        def run(number: int, item):
            if failed.is_set():
                return None
            context.setLocalProperty("spark.scheduler.pool", f"load-{number % max(1, self.parallel)}")
            try:
                return step(item)
            except Exception as error:
                if stop_at_error:
                    failed.set()
                return error
            finally:
                context.setLocalProperty("spark.scheduler.pool", None)

        if min(self.parallel, len(items)) <= 1:
            return [run(0, item) for item in items]
        with ThreadPoolExecutor(min(self.parallel, len(items))) as pool:
            return list(pool.map(inheritable_thread_target(self.spark)(run), range(len(items)), items))

    def _each(self, specs, step, layer: str, on_error: OnError) -> list[Loaded]:
        """Loads of all sources side by side.  Under ABORT those that run when one fails still end, then its error is raised."""
        results = []
        done = self._side_by_side(list(specs), step, stop_at_error=on_error is OnError.ABORT)
        for spec, result in zip(specs, done):
            if isinstance(result, Exception):
                log.error("%s load of %s failed", layer, spec.relative_path, exc_info=result)
                result = Loaded(spec, 0, None, runlog.FAILED, result)
                self._log(result, layer, self.path(layer, spec), self.clock())
            results += [] if result is None else [result]
        errors = [x.error for x in results if x.error is not None]
        if errors and on_error is OnError.ABORT:
            raise errors[0]
        return results

    def _record(self, spec: TableSpec, batches: Sequence[str], status: str) -> None:
        rows = landing.ledger_rows(self.spark, spec.relative_path, batches, status, self.clock())
        with self._appending:
            landing.record(self.ledger_path, rows)

    def _measure(self, metrics: measures.LoadMetrics, layer: str, spec: TableSpec, batches: Sequence[str]) -> None:
        if self.measured or spec.rules:
            rows = metrics.measures(layer, spec.relative_path, batches, self.clock())
            with self._appending:
                tables.append(measures.measures_frame(self.spark, rows).coalesce(1), self.measures_path)

    def read_measures(self) -> DataFrame:
        """What loads measured: rows, rows kept apart, nulls per column and rows per broken rule."""
        return measures.read_measures(self.spark, self.measures_path)

    def parity(self) -> DataFrame:
        """Rows and nulls that bronze loads read, beside those of the batches when they were landed; reads no layer."""
        return measures.parity(self.read_measures(), "landing", "bronze")

    def _log(self, done: Loaded, layer: str, path: str, start: datetime, consolidated: bool = False) -> None:
        entry = runlog.RunEntry(
            start=start,
            end=self.clock(),
            load_type=done.spec.load_type,
            table=done.spec.table,
            layer=layer,
            path=path,
            status=done.status,
            rows=done.rows,
            last_record=done.last if done.spec.incremental else start,
            host=None if consolidated else done.spec.host,
            database=None if consolidated else done.spec.database,
        )
        with self._appending:
            runlog.append_log(self.spark, self.log_path, [entry])
