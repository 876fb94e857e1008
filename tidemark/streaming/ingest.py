"""Landing folders as a stream: the checkpoint takes the ledger's place.

``availableNow`` processes everything that has landed since the last run and stops, so the same job can be scheduled
like a batch.  Micro-batches are upserted, so a batch that is delivered again after a crash changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark import spec as S
from tidemark.operators.enrich import add_lineage
from tidemark.operators.joins import fits_broadcast, semi_join
from tidemark.operators.upsert import dedupe_latest
from tidemark.sources import landing, paths, tables
from tidemark.spec import TableSpec


def landed_stream(
    spark: SparkSession, base: str, schema: StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """All batches under ``base`` as an unbounded frame with their ``batch_id``."""
    reader = spark.readStream.schema(StructType([*schema.fields]).add(landing.BATCH, "string")).option("basePath", base)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{base}/{landing.BATCH}=*")


def bronze_writer(
    spec: TableSpec, path: str, as_of: datetime | None = None
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that enriches a micro-batch and upserts it by hash key."""

    def write(batch: DataFrame, _epoch: int) -> None:
        enriched = add_lineage(batch, spec, as_of)
        spark = batch.sparkSession
        unique = dedupe_latest(enriched, [S.HASH_KEY], [landing.BATCH, spec.watermark]).drop(landing.BATCH).persist()
        try:
            tables.recover(spark, path)
            stored = tables.read_partitioned(spark, path) if paths.has_data(spark, path) else None
            rows = unique if stored is None else _not_older(unique, stored, spec.watermark)
            tables.upsert_partitions(spark, path, rows, [S.HASH_KEY], S.PARTITION_DATE, on_duplicate="keep")
        finally:
            unique.unpersist()

    return write


def _not_older(rows: DataFrame, stored: DataFrame, watermark: str) -> DataFrame:
    """Rows without a newer one of the same key in the table: files are taken up by their modification time, so a batch may
    come after one that was landed later."""
    keys = rows.select(S.HASH_KEY)
    known = semi_join(stored.select(S.HASH_KEY, watermark), keys, [S.HASH_KEY], False, small=fits_broadcast(keys))
    joined = rows.join(known.withColumnRenamed(watermark, "__stored"), S.HASH_KEY, "left")
    # Without a watermark on either side the order of arrival decides, as it does between batches.
    current = F.coalesce(F.col(watermark) >= F.col("__stored"), F.lit(True))
    return joined.where(current).select(*rows.columns)


def stream_to_bronze(
    spark: SparkSession,
    spec: TableSpec,
    base: str,
    schema: StructType,
    path: str,
    checkpoint: str,
    as_of: datetime | None = None,
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Process what has landed and stop; await the returned query."""
    return (
        landed_stream(spark, base, schema, files_per_trigger)
        .writeStream.foreachBatch(bronze_writer(spec, path, as_of))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
