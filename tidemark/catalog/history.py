"""Slowly changing dimension over event histories: every event stands for an employee snapshot."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.catalog.registry import query, table
from tidemark.operators import scd2
from tidemark.operators.carry import advance_versions, carried_state
from tidemark.operators.intervals import valid_versions
from tidemark.operators.scd2 import VersionSpec
from tidemark.operators.watermarks import filter_lookback
from tidemark.spec import parse_instant

TRACKED = ("EmployeeID", "Status", "Team", "HireDate", "LastDayWorked", "TerminationDate", "TerminationReason")

# Promises that no entity's history is too long for one task.
SPEC = VersionSpec(
    entity="EmployeeID", order="LoadDate", tracked=TRACKED, filled=("Team",), max_rows_per_entity=None
)
# The same over every event, where one user may hold any share of the rows.
UNBOUNDED = VersionSpec(entity="EmployeeID", order="LoadDate", tracked=TRACKED, filled=("Team",))

SPLIT_DAY = "2024-01-16"


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an employee snapshot; errors stand for terminations, views for a missing team."""
    events = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    ended = F.col("event_type") == "error"
    return events.select(
        F.col("user_id").alias("EmployeeID"),
        F.col("ts").alias("LoadDate"),
        F.col("event_type").alias("Status"),
        F.nullif(F.col("event_type"), F.lit("view")).alias("Team"),
        F.lit("2020-01-01").cast("date").alias("HireDate"),
        F.when(ended, day).alias("LastDayWorked"),
        F.when(ended & (F.col("event_id") % 7 != 0), day).alias("TerminationDate"),
        F.when(F.col("event_id") % 2 == 0, "<None>").otherwise("moved").alias("TerminationReason"),
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user and day, for the steps that have day grain by themselves."""
    return scd2.latest_per_day(snapshots(spark, sf_dir), "EmployeeID", "LoadDate")


_SNAPSHOTS = """
snapshots AS (
  SELECT user_id AS "EmployeeID", ts AS "LoadDate", event_type AS "Status", nullif(event_type, 'view') AS "Team",
         DATE '2020-01-01' AS "HireDate",
         CASE WHEN event_type = 'error' THEN CAST(ts AS DATE) END AS "LastDayWorked",
         CASE WHEN event_type = 'error' AND event_id % 7 <> 0 THEN CAST(ts AS DATE) END AS "TerminationDate",
         CASE WHEN event_id % 2 = 0 THEN '<None>' ELSE 'moved' END AS "TerminationReason"
  FROM events)"""

_DAILY = f"""{_SNAPSHOTS},
history AS (SELECT * FROM snapshots
  QUALIFY row_number() OVER (PARTITION BY "EmployeeID", CAST("LoadDate" AS DATE) ORDER BY "LoadDate" DESC) = 1)"""

_HASH = """sha256(concat_ws('|', CAST("EmployeeID" AS VARCHAR), "Status", "Team", CAST("HireDate" AS VARCHAR),
  CAST("LastDayWorked" AS VARCHAR), CAST("TerminationDate" AS VARCHAR), "TerminationReason"))"""


def _hashed(source: str, name: str = "hashed") -> str:
    return f"""{name} AS (SELECT *, {_HASH} AS "RowHashKey" FROM {source})"""


def _changes(source: str = "hashed", name: str = "changes") -> str:
    return f"""{name} AS (SELECT * EXCLUDE (p) FROM (
  SELECT *, lag("RowHashKey") OVER (PARTITION BY "EmployeeID" ORDER BY "LoadDate") AS p FROM {source})
  WHERE (p IS NULL AND "TerminationDate" IS NULL) OR p <> "RowHashKey")"""


def _ended(source: str = "changes", name: str = "ended") -> str:
    return f"""{name} AS (SELECT * EXCLUDE (pt, pl) FROM (
  SELECT *, lag("TerminationDate") OVER w AS pt, lag("LastDayWorked") OVER w AS pl FROM {source}
  WINDOW w AS (PARTITION BY "EmployeeID" ORDER BY "LoadDate"))
  WHERE pt IS NULL OR pl IS NULL OR "TerminationDate" IS NULL OR "LastDayWorked" IS NULL)"""


def _filled(source: str = "ended", name: str = "filled") -> str:
    return f"""{name} AS (SELECT * REPLACE (last_value("Team" IGNORE NULLS) OVER (PARTITION BY "EmployeeID"
  ORDER BY "LoadDate" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS "Team") FROM {source})"""


def _folded(source: str = "filled", name: str = "folded") -> str:
    return f"""{name} AS (SELECT * FROM {source}
  QUALIFY row_number() OVER (PARTITION BY "EmployeeID", CAST("LoadDate" AS DATE) ORDER BY "LoadDate" DESC) = 1)"""


def _dated(source: str = "filled", name: str = "dated") -> str:
    return f"""{name} AS (SELECT * EXCLUDE (n), CAST("LoadDate" AS DATE) AS "EffectiveStartDate",
  CASE WHEN n IS NULL THEN DATE '9999-12-31' ELSE CAST(n AS DATE) - 1 END AS "EffectiveEndDate"
  FROM (SELECT *, lead("LoadDate") OVER (PARTITION BY "EmployeeID" ORDER BY "LoadDate") AS n FROM {source}))"""


def _opened(source: str = "dated", name: str = "opened") -> str:
    return f"""{name} AS (SELECT * REPLACE (
  CASE WHEN "HireDate" IS NOT NULL AND "TerminationDate" IS NOT NULL AND "LastDayWorked" IS NOT NULL
       THEN DATE '9999-12-31' ELSE "EffectiveEndDate" END AS "EffectiveEndDate") FROM {source})"""


def _settled(source: str = "opened", name: str = "settled") -> str:
    return f"""{name} AS (SELECT * REPLACE (
  CASE WHEN "TerminationDate" IS NULL OR "TerminationReason" = '<None>' THEN 'null' ELSE "TerminationReason" END
    AS "TerminationReason",
  CASE WHEN "TerminationDate" IS NOT NULL THEN 'Terminated' ELSE "Status" END AS "Status") FROM {source})"""


def _numbered(source: str = "settled", name: str = "numbered") -> str:
    return f"""{name} AS (SELECT *, CAST(CAST(1000000 + "EmployeeID" AS VARCHAR)
  || replace(CAST("EffectiveStartDate" AS VARCHAR), '-', '') AS BIGINT) AS "Dim_ID" FROM {source})"""


def _chain(source: str, prefix: str = "") -> str:
    """All steps from raw history rows to versions; the last name is ``{prefix}numbered``."""
    steps = ["hashed", "changes", "ended", "filled", "folded", "dated", "opened", "settled", "numbered"]
    builders = [_hashed, _changes, _ended, _filled, _folded, _dated, _opened, _settled, _numbered]
    parts, previous = [], source
    for step, build in zip(steps, builders):
        parts.append(build(previous, prefix + step))
        previous = prefix + step
    return ",\n".join(parts)


@query(f"WITH {_SNAPSHOTS}, {_hashed('snapshots')} SELECT * FROM hashed")
def scd2_row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.add_row_hash(snapshots(spark, sf_dir), SPEC)


@query(f"WITH {_SNAPSHOTS}, {_hashed('snapshots')}, {_changes()} SELECT * FROM changes")
def scd2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.keep_changes(scd2_row_hash(spark, sf_dir), SPEC)


@query(f"WITH {_SNAPSHOTS}, {_hashed('snapshots')}, {_ended('hashed')} SELECT * FROM ended")
def scd2_terminal_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.drop_after_end(scd2_row_hash(spark, sf_dir), SPEC)


@query(f"WITH {_SNAPSHOTS}, {_filled('snapshots')} SELECT * FROM filled")
def scd2_forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.fill_forward(snapshots(spark, sf_dir), SPEC)


@query(f"WITH {_DAILY}, {_dated('history')} SELECT * FROM dated")
def scd2_effective_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.add_effective_dates(daily(spark, sf_dir), SPEC)


@query(f"WITH {_DAILY}, {_dated('history')}, {_opened()} SELECT * FROM opened")
def scd2_terminated_open_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.open_ended_versions(scd2.add_effective_dates(daily(spark, sf_dir), SPEC), SPEC)


@query(f"WITH {_SNAPSHOTS}, {_settled('snapshots')} SELECT * FROM settled")
def scd2_status_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.settle_status(snapshots(spark, sf_dir), SPEC)


@query(f"""WITH {_DAILY}, {_dated('history')}, {_numbered('dated')}
SELECT "EmployeeID", "LoadDate", "EffectiveStartDate", "Dim_ID" FROM numbered""")
def scd2_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = scd2.add_effective_dates(daily(spark, sf_dir), SPEC)
    return scd2.add_surrogate_key(dated, SPEC).select("EmployeeID", "LoadDate", "EffectiveStartDate", "Dim_ID")


@query(f"WITH {_SNAPSHOTS}, {_chain('snapshots')} SELECT * FROM numbered")
def scd2_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.versions(snapshots(spark, sf_dir), SPEC)


@query(f"WITH {_SNAPSHOTS}, {_chain('snapshots')} SELECT * FROM numbered")
def scd2_every_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No reduction to days first: versions of one day are folded after change detection."""
    return scd2.versions(snapshots(spark, sf_dir), UNBOUNDED)


@query(f"WITH {_SNAPSHOTS}, {_chain('snapshots')} SELECT * FROM numbered")
def scd2_every_event_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a bound that many entities exceed, so that their histories are worked on in segments."""
    return scd2.versions(snapshots(spark, sf_dir), replace(UNBOUNDED, max_rows_per_entity=10))


@query(f"""WITH {_SNAPSHOTS}, {_chain('snapshots')}
SELECT count(*) AS versions, count(*) AS ids, CAST(0 AS BIGINT) AS inverted, CAST(0 AS BIGINT) AS overlapping FROM numbered""")
def scd2_every_event_is_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids are unique, no version ends before it starts, and only ended versions, which stay open, reach into the next."""
    built = scd2_every_event(spark, sf_dir)
    following = Window.partitionBy("EmployeeID").orderBy("EffectiveStartDate")
    after = F.lead("EffectiveStartDate").over(following)
    reaches = (F.col("EffectiveEndDate") >= F.col("__next")) & (F.col("Status") != scd2.TERMINATED)
    return built.withColumn("__next", after).agg(
        F.count("*").alias("versions"),
        F.countDistinct("Dim_ID").alias("ids"),
        F.count_if(F.col("EffectiveEndDate") < F.col("EffectiveStartDate")).alias("inverted"),
        F.count_if(reaches).alias("overlapping"),
    )


_LAYOUT = """"Dim_ID", "EmployeeID", "Status", "Team", "HireDate", "LastDayWorked", "TerminationDate", "TerminationReason",
  CAST("LoadDate" AS DATE) AS "LoadDate", "EffectiveStartDate", "EffectiveEndDate", "RowHashKey" """
LAYOUT = [
    "Dim_ID", *TRACKED, "LoadDate", "EffectiveStartDate", "EffectiveEndDate", "RowHashKey",
]


@query(f"WITH {_SNAPSHOTS}, {_chain('snapshots')} SELECT {_LAYOUT.replace('\"Status\"', '\"Status\" AS \"State\"')} FROM numbered")
def scd2_final_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rename, timestamps to dates, fixed column order."""
    columns = ["State" if c == "Status" else c for c in LAYOUT]
    return scd2.finish(scd2_full(spark, sf_dir), columns, {"Status": "State"})


def _before_split(history: DataFrame) -> DataFrame:
    return history.where(F.col("LoadDate") < F.lit(SPLIT_DAY).cast("timestamp_ntz"))


def _since_split(history: DataFrame) -> DataFrame:
    return history.where(F.col("LoadDate") >= F.lit(SPLIT_DAY).cast("timestamp_ntz"))


@query(f"WITH {_SNAPSHOTS}, {_chain('snapshots')} SELECT * FROM numbered")
def scd2_closeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches: the second closes versions that the first left open.  Equal to one full build."""
    history = snapshots(spark, sf_dir)
    target = scd2.versions(_before_split(history), SPEC)
    return scd2.merge_versions(target, history, _since_split(history), SPEC)


@query(f"""WITH {_SNAPSHOTS},
early AS (SELECT * FROM snapshots WHERE "LoadDate" < TIMESTAMP '{SPLIT_DAY}'),
late AS (SELECT * FROM snapshots WHERE "LoadDate" >= TIMESTAMP '{SPLIT_DAY}' - INTERVAL 2 DAY),
{_chain('early', 'e_')}, {_chain('late', 'l_')}
SELECT * FROM e_numbered UNION ALL
SELECT * FROM l_numbered WHERE "RowHashKey" NOT IN (SELECT "RowHashKey" FROM e_numbered)""")
def scd2_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert-only load of a batch with two days of look-back: open versions of the first batch stay open."""
    history = snapshots(spark, sf_dir)
    target = scd2.versions(_before_split(history), SPEC)
    recent = filter_lookback(history, "LoadDate", parse_instant(f"{SPLIT_DAY}T00:00:00Z"), days=2)
    return scd2.insert_versions(target, scd2.versions(recent, SPEC), SPEC)


@query(f"""WITH {_SNAPSHOTS}, {_chain('snapshots')}
SELECT max("EffectiveStartDate") AS watermark, count(*) AS versions FROM numbered""")
def scd2_next_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension's own watermark: its largest effective start."""
    built = scd2_full(spark, sf_dir)
    return built.agg(F.max("EffectiveStartDate").alias("watermark"), F.count("*").alias("versions"))


@query(f"WITH {_SNAPSHOTS}, {_chain('snapshots')} SELECT * FROM numbered")
def scd2_carried_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches onto carried state, the last with rows that come late for a few entities.  Equal to one full build."""
    history = snapshots(spark, sf_dir)
    late = F.col("EmployeeID") % 20 == 7
    first, second = _before_split(history).where(~late), _since_split(history).where(~late)
    target, state = scd2.versions(first, SPEC), carried_state(first, SPEC)
    middle = advance_versions(target, state, first, second, SPEC)
    tail = F.col("LoadDate") >= F.lit(SPLIT_DAY).cast("timestamp_ntz")
    some = advance_versions(middle.versions, middle.state, history, history.where(late & tail), SPEC)
    return advance_versions(some.versions, some.state, history, history.where(late & ~tail), SPEC).versions


_AS_OF_SQL = f"""WITH {_SNAPSHOTS}, {_chain('snapshots')},
met AS (SELECT e.event_id, e.user_id, e.ts, n."Dim_ID", n."Status", n."EffectiveStartDate" AS s FROM events e
  LEFT JOIN numbered n ON n."EmployeeID" = e.user_id AND CAST(e.ts AS DATE) BETWEEN n."EffectiveStartDate" AND n."EffectiveEndDate")"""


@query(f"""{_AS_OF_SQL} SELECT event_id, user_id, ts, "Dim_ID", "Status" FROM met
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY s DESC NULLS LAST) = 1""")
def events_to_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the version of its user that was valid on its day; ended versions stay open, the last start wins."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    built = scd2_full(spark, sf_dir).withColumnRenamed("EmployeeID", "user_id")
    return valid_versions(events, built, "user_id", "ts", columns=["Dim_ID", "Status"], bin_days=7, max_rows=1000)


@query(f"""{_AS_OF_SQL} SELECT event_id, "Dim_ID", "Status" FROM met""")
def events_to_all_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with every version that covers its day, hot users spread over buckets."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    built = scd2_full(spark, sf_dir).withColumnRenamed("EmployeeID", "user_id")
    options = {"columns": ["Dim_ID", "Status"], "bin_days": 7, "latest_start": False, "max_rows": 5}
    return valid_versions(events, built, "user_id", "ts", **options).drop("user_id", "ts")
