"""Landed batches and the ledger that records which of them have been processed."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.temporal import instant
from tidemark.operators.conform import conform_union
from tidemark.sources import paths, tables
from tidemark.sources.rows import local_frame

BATCH = "batch_id"

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField(BATCH, T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("recorded_utc", T.TimestampType()),
    ]
)


def batch_name(table: str, moment: datetime) -> str:
    """Names sort in time order."""
    return f"{table}_{moment:%Y-%m-%dT%H-%M-%S.%f}Z"


def land(df: DataFrame, base: str, batch_id: str) -> str:
    """Write one pull as its own folder, with its schema beside the data.  Landing the same batch again replaces it."""
    path = f"{base}/{BATCH}={batch_id}"
    df.write.mode("overwrite").parquet(path)
    paths.replace_text(df.sparkSession, f"{path}/{tables.SCHEMA_FILE}", df.schema.json())
    return path


def batch_folders(spark: SparkSession, base: str) -> list[str]:
    """Names of all batch folders in name order, in one listing; a crashed write may have left some of them behind."""
    return [name.split("=", 1)[1] for name in paths.subfolders(spark, base) if name.startswith(f"{BATCH}=")]


def committed(spark: SparkSession, base: str, batches: Sequence[str]) -> list[str]:
    """Those of the batches whose write was completed: one request each, so leave out what is known to be done."""
    return [batch for batch in batches if paths.has_data(spark, f"{base}/{BATCH}={batch}")]


def landed_batches(spark: SparkSession, base: str) -> list[str]:
    """Committed batches in name order; a folder that a crashed write left behind does not count."""
    return committed(spark, base, batch_folders(spark, base))


def batch_schema(spark: SparkSession, base: str, batch: str) -> T.StructType:
    """Schema of one landed batch: as kept at landing, else from a footer of that batch alone."""
    path = f"{base}/{BATCH}={batch}"
    text = paths.read_text(spark, f"{path}/{tables.SCHEMA_FILE}")
    return T.StructType.fromJson(json.loads(text)) if text else spark.read.parquet(path).schema


def read_batches(spark: SparkSession, base: str, batches: Sequence[str]) -> DataFrame:
    """The given batches as one frame with their ``batch_id``; only their folders are listed and read.

    Batches of one schema are read together, under the schema kept at landing: no footers are merged, and a source that
    changes a column's type between two pulls blocks neither of them.  The groups are conformed like servers are, so a
    column that was a number and became text is text in both.
    """
    groups: dict[str, list[str]] = {}
    for batch in batches:
        groups.setdefault(batch_schema(spark, base, batch).json(), []).append(batch)

    def read(schema: str, members: list[str]) -> DataFrame:
        own = T.StructType.fromJson(json.loads(schema))
        own = T.StructType([f for f in own.fields if f.name != BATCH]).add(BATCH, T.StringType())
        return spark.read.schema(own).option("basePath", base).parquet(*[f"{base}/{BATCH}={batch}" for batch in members])

    # Newest first: of two spellings of a column the newest stays.
    frames = [read(schema, members) for schema, members in sorted(groups.items(), key=lambda g: max(g[1]), reverse=True)]
    stacked = conform_union(frames)
    return stacked.select(*[c for c in stacked.columns if c != BATCH], BATCH)


def latest_batch(df: DataFrame, batch: str = BATCH) -> DataFrame:
    """Rows of the newest batch of a frame.  The maximum is a one-row aggregate, so broadcasting it is safe."""
    newest = df.agg(F.max(batch).alias(batch))
    return df.join(F.broadcast(newest), batch, "left_semi").select(*df.columns)


def latest_landed(spark: SparkSession, base: str) -> str | None:
    newest = (b for b in reversed(batch_folders(spark, base)) if committed(spark, base, [b]))
    return next(newest, None)


# --- ledger ----------------------------------------------------------------------------------------------------------


def pending_batches(batches: DataFrame, ledger: DataFrame, identity: Sequence[str] = ("source", BATCH)) -> DataFrame:
    """Landed batches without a ``processed`` entry; failed ones are pending again."""
    done = ledger.where(F.col("status") == "processed").select(*identity).distinct()
    return batches.join(done, list(identity), "left_anti").select(*batches.columns)


def ledger_rows(
    spark: SparkSession, source: str, batches: Sequence[str], status: str, as_of: datetime | None = None
) -> DataFrame:
    moment = F.current_timestamp() if as_of is None else instant(as_of)
    rows = local_frame(
        spark, [(source, batch, status) for batch in batches], f"source string, {BATCH} string, status string"
    )
    return rows.withColumn("recorded_utc", moment)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    if not paths.exists(spark, path):
        return local_frame(spark, [], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def record(ledger_path: str, rows: DataFrame) -> None:
    tables.append(rows, ledger_path)
