"""Run log: one row per load and layer, with counts taken from the write job itself."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.temporal import instant
from tidemark.sources import paths, tables
from tidemark.sources.rows import local_frame
from tidemark.spec import LoadType, as_utc

# The columns of the stored log.  Counts take 64 bits, so that no load is too large to be logged.
RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("start_datetime_utc", T.TimestampType()),
        T.StructField("end_datetime_utc", T.TimestampType()),
        T.StructField("load_type", T.StringType()),
        T.StructField("source_server", T.StringType()),
        T.StructField("source_database", T.StringType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("medallion_layer", T.StringType()),
        T.StructField("data_lake_path", T.StringType()),
        T.StructField("load_execution_time", T.FloatType()),
        T.StructField("notebook_execution_status", T.StringType()),
        T.StructField("records_inserted", T.LongType()),
        T.StructField("last_record_inserted_datetime", T.TimestampType()),
    ]
)

# Status values.
SUCCESS, EMPTY, FAILED = "Success", "Empty", "Failed"

# The row that a new run log starts with.
SEED_START = datetime(9999, 1, 1)
SEED_END = datetime(9999, 12, 31, 11, 59, 59)


@dataclass(frozen=True)
class RunEntry:
    start: datetime
    end: datetime
    load_type: LoadType
    table: str
    layer: str
    path: str
    status: str
    rows: int = 0
    last_record: datetime | None = None
    host: str | None = None
    database: str | None = None

    def as_row(self) -> tuple:
        start, end = as_utc(self.start), as_utc(self.end)
        last = None if self.last_record is None else as_utc(self.last_record)
        return (
            start,
            end,
            self.load_type.value,
            self.host,
            self.database,
            self.table,
            self.layer,
            self.path,
            (end - start).total_seconds(),
            self.status,
            self.rows,
            last,
        )


def status_of(rows: int) -> str:
    """A batch without rows is normal, not a failure."""
    return SUCCESS if rows else EMPTY


def log_frame(spark: SparkSession, entries: list[RunEntry]) -> DataFrame:
    return local_frame(spark, [e.as_row() for e in entries], RUN_LOG_SCHEMA)


def seed_row() -> tuple:
    test = ("full load", "test", "test", "test", "bronze", "bronze//")
    return (as_utc(SEED_START), as_utc(SEED_END), *test, 0.0, "success", 0, as_utc(SEED_END))


def append_log(spark: SparkSession, path: str, entries: list[RunEntry]) -> None:
    """Append entries; a new log first gets its seed row."""
    if not paths.exists(spark, path):
        tables.overwrite(local_frame(spark, [seed_row()], RUN_LOG_SCHEMA), path)
    if entries:
        tables.append(log_frame(spark, entries), path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(path)


class WriteMetrics:
    """Row count and largest watermark of a frame, collected while it is written, without another pass.

    Watermarks pass as microseconds, so dates, instants and wall-clock values come out alike: in UTC.
    """

    def __init__(self, watermark: str | None = None) -> None:
        self._observation = Observation()
        self._measured: dict | None = None
        self._watermark = watermark

    def aggregates(self) -> list[Column]:
        mark = F.unix_micros(F.col(self._watermark).cast("timestamp")) if self._watermark else F.lit(None).cast("long")
        return [F.count(F.lit(1)).alias("rows"), F.max(mark).alias("last")]

    def attach(self, df: DataFrame) -> DataFrame:
        return df.observe(self._observation, *self.aggregates())

    def measure(self, df: DataFrame) -> None:
        """Count in a pass of its own, for a frame that was taken out of the plan."""
        self._measured = df.agg(*self.aggregates()).head().asDict()

    @property
    def observed(self) -> bool:
        """False if AQE took the frame out of the plan while it ran, which it does only where nothing is left of it."""
        try:
            return bool(self._observation.get)
        except Py4JJavaError:
            return False

    def value(self, name: str, default: int | None = None) -> int | None:
        if self._measured is not None:
            return self._measured.get(name, default)
        return self._observation.get.get(name, default) if self.observed else default

    @property
    def rows(self) -> int:
        return self.value("rows", 0)

    @property
    def last(self) -> datetime | None:
        micros = self.value("last")
        return None if micros is None else from_micros(micros)


def from_micros(value: int) -> datetime:
    seconds, micros = divmod(value, 1_000_000)
    return datetime.fromtimestamp(seconds, timezone.utc).replace(microsecond=micros)


def consolidated(
    per_source: DataFrame, table: str, layer: str, path: str, start: datetime, end: datetime, load_type: LoadType
) -> DataFrame:
    """Fold one row per source (``status``, ``rows``, ``last``) into one log row per outcome.

    Host and database are null, because the row speaks for all sources of the table.
    """
    seconds = (as_utc(end) - as_utc(start)).total_seconds()
    folded = per_source.groupBy("status").agg(F.sum("rows").alias("rows"), F.max("last").alias("last"))
    return folded.select(
        instant(start).alias("start_datetime_utc"),
        instant(end).alias("end_datetime_utc"),
        F.lit(load_type.value).alias("load_type"),
        F.lit(None).cast("string").alias("source_server"),
        F.lit(None).cast("string").alias("source_database"),
        F.lit(table).alias("source_table"),
        F.lit(layer).alias("medallion_layer"),
        F.lit(path).alias("data_lake_path"),
        F.lit(seconds).cast("float").alias("load_execution_time"),
        F.col("status").alias("notebook_execution_status"),
        F.col("rows").cast("long").alias("records_inserted"),
        F.col("last").cast("timestamp").alias("last_record_inserted_datetime"),
    )

