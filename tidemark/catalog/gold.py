"""Gold flows over servers that join late, and what the flows write into the run log."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import spec as S
from tidemark.catalog.flows import NOTED
from tidemark.catalog.history import _SNAPSHOTS, LAYOUT, SPEC, _LAYOUT, _chain, snapshots
from tidemark.catalog.layers import AS_OF
from tidemark.catalog.registry import query, table
from tidemark.operators import runlog, scd2
from tidemark.plans.medallion import Medallion, OnError
from tidemark.session import scratch_path
from tidemark.sources import tables
from tidemark.sources.rows import local_frame
from tidemark.spec import TableSpec

EVENTS = TableSpec("srv-A", "web", "dbo", "events", ("event_id",), "loaded")
HISTORY = TableSpec("srv-A", "hr", "dbo", "people", ("EmployeeID", "LoadDate"), "loaded")
EARLY, LATE = "{0} % 3 <> 0", "{0} % 3 = 0"  # which users the servers hold


def _week(stamp: str) -> Column:
    return F.date_trunc("week", stamp).cast("timestamp_ntz")


def _both_servers(spec: TableSpec) -> list[TableSpec]:
    return [spec, replace(spec, host="srv-B")]


@query("""
SELECT CAST(e.event_id AS VARCHAR) AS "Fact_ID", sha256(CAST(e.event_id AS VARCHAR)) AS "HashKey", e.event_id, e.user_id,
       e.ts, e.event_type, CAST(date_trunc('week', e.ts) AS DATE) AS "__PartitionDateUTC", a.event_id AS "callId", a.value AS amount,
       a.props AS details
FROM events e LEFT JOIN events a ON a.event_id = e.event_id AND a.event_id % 3 <> 0
""")
def gold_late_server(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A server that joins after the first commit brings rows older than that commit: the fact holds them all."""
    lake = Medallion(spark, scratch_path(spark, "late"))
    source = table(spark, sf_dir, "events").withColumn("loaded", _week("ts"))
    rows = source.select("event_id", "user_id", "ts", "event_type", "loaded")
    details = source.where(F.col("event_id") % 3 != 0).select("event_id", "user_id", "value", "props", "loaded")
    notes = replace(EVENTS, table="notes")
    for number, (host, of_server) in enumerate([("srv-A", EARLY), ("srv-B", LATE)]):
        for spec, df in ((EVENTS, rows), (notes, details)):
            own = replace(spec, host=host)
            lake.land(own, df.where(of_server.format("user_id")), datetime(2024, 2, 1 + number))
            lake.bronze(own, AS_OF)
            lake.silver(_both_servers(spec))
        lake.fact("fact_events", EVENTS, notes, NOTED, ["Fact_ID", "event_id"], S.PARTITION_DATE)
        lake.commit()
    return tables.read_partitioned(spark, lake.path("gold", "fact_events"))


def _seed(spark: SparkSession, like: DataFrame) -> DataFrame:
    """The row a new dimension starts with: id 0, all else null."""
    nothing = local_frame(spark, [(0,)], "Dim_ID long")
    return nothing.select(*[F.lit(0 if f.name == "Dim_ID" else None).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def _finish(df: DataFrame) -> DataFrame:
    return scd2.finish(df, LAYOUT)


_SEEDED = f"""WITH {_SNAPSHOTS}, {_chain('snapshots')} SELECT {_LAYOUT} FROM numbered UNION ALL
SELECT 0, {', '.join(['NULL'] * (len(LAYOUT) - 1))}"""


@query(_SEEDED)
def gold_dimension_late_server(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seeded type-2 dimension whose second server joins after the first commit.  Equal to one full build."""
    lake = Medallion(spark, scratch_path(spark, "people"))
    history = snapshots(spark, sf_dir).withColumn("loaded", _week("LoadDate"))
    build = lambda df: _finish(scd2.versions(df, SPEC))
    seed = _seed(spark, build(history))
    for number, (host, of_server) in enumerate([("srv-A", EARLY), ("srv-B", LATE)]):
        own = replace(HISTORY, host=host)
        lake.land(own, history.where(of_server.format("EmployeeID")), datetime(2024, 2, 1 + number))
        lake.bronze(own, AS_OF)
        lake.silver(_both_servers(HISTORY))
        lake.dimension("dim_people", HISTORY, SPEC, build, seed)
        lake.commit()
    return tables.read_snapshot(spark, lake.path("gold", "dim_people"))


@query(_SEEDED)
def gold_dimension_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from carried state: two weeks in order, then the second server's rows.  Equal to one full build."""
    lake = Medallion(spark, scratch_path(spark, "carried"))
    history = snapshots(spark, sf_dir).withColumn("loaded", _week("LoadDate"))
    build = lambda df: _finish(scd2.versions(df, SPEC))
    seed = _seed(spark, build(history))
    cut = "loaded {0} TIMESTAMP_NTZ '2024-01-15'"
    for number, (host, part) in enumerate([("srv-A", cut.format("<")), ("srv-A", cut.format(">=")), ("srv-B", "true")]):
        own = replace(HISTORY, host=host)
        of_server = EARLY if host == "srv-A" else LATE
        lake.land(own, history.where(of_server.format("EmployeeID")).where(part), datetime(2024, 2, 1 + number))
        lake.bronze(own, AS_OF)
        lake.silver(_both_servers(HISTORY))
        lake.dimension("dim_people", HISTORY, SPEC, build, seed, layout=_finish)
        lake.commit()
    return tables.read_snapshot(spark, lake.path("gold", "dim_people"))


@query("""
WITH loads AS (
  SELECT 'landing' AS layer, 'srv-A' AS host, 'events' AS source_table, 'Success' AS status, count(*) AS n, max(date_trunc('week', ts)) AS last
  FROM events WHERE user_id % 3 <> 0
  UNION ALL SELECT 'landing', 'srv-B', 'events', 'Failed', 0, NULL
  UNION ALL SELECT 'bronze', 'srv-A', 'events', 'Success', count(*), max(date_trunc('week', ts)) FROM events WHERE user_id % 3 <> 0
  UNION ALL SELECT 'silver', NULL, 'events', 'Success', count(*), max(date_trunc('week', ts)) FROM events WHERE user_id % 3 <> 0
  UNION ALL SELECT 'gold', NULL, 'fact_events', 'Success', count(*), max(date_trunc('week', ts)) FROM events WHERE user_id % 3 <> 0)
SELECT TIMESTAMP '2024-07-01 12:00:00' AS start_datetime_utc, TIMESTAMP '2024-07-01 12:00:00' AS end_datetime_utc,
       'incremental' AS load_type, host AS source_server, CASE WHEN host IS NOT NULL THEN 'web' END AS source_database, source_table,
       layer AS medallion_layer, status AS notebook_execution_status, n AS records_inserted, CAST(last AS TIMESTAMP) AS last_record_inserted_datetime
FROM loads
""")
def run_log_of_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that landing, bronze, silver and gold leave in the run log, one server of two being out of reach."""
    lake = Medallion(spark, scratch_path(spark, "logged"), clock=lambda: AS_OF.replace(tzinfo=timezone.utc))
    source = table(spark, sf_dir, "events").withColumn("loaded", _week("ts"))

    def read(spec: TableSpec) -> DataFrame:
        if spec.host == "srv-B":
            raise ConnectionError("no such server")
        return source.where(EARLY.format("user_id"))

    specs = _both_servers(EVENTS)
    lake.land_all(specs, read, OnError.ISOLATE)
    lake.bronze_all(specs, AS_OF)
    lake.silver(specs)
    lake.fact("fact_events", EVENTS, EVENTS, NOTED, ["Fact_ID", "event_id"], S.PARTITION_DATE)
    written = runlog.read_log(spark, lake.log_path).where(F.col("source_server").isNull() | (F.col("source_server") != "test"))
    stamps = ("start_datetime_utc", "end_datetime_utc", "last_record_inserted_datetime")
    return written.drop("data_lake_path", "load_execution_time").withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


@query("""
SELECT 'people' AS source_table, CASE WHEN user_id % 3 = 0 THEN 'srv-B' ELSE 'srv-A' END AS source_server,
       CAST(max(date_trunc('week', ts)) AS TIMESTAMP) AS watermark FROM events GROUP BY ALL
""")
def watermark_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each server of a table is committed to after a flow over two of them."""
    lake = Medallion(spark, scratch_path(spark, "frontier"))
    history = snapshots(spark, sf_dir).withColumn("loaded", _week("LoadDate"))
    for host, of_server in (("srv-A", EARLY), ("srv-B", LATE)):
        own = replace(HISTORY, host=host)
        lake.land(own, history.where(of_server.format("EmployeeID")), datetime(2024, 2, 1))
        lake.bronze(own, AS_OF)
    lake.silver(_both_servers(HISTORY))
    return lake.commit().select(
        F.col("table").alias("source_table"), F.col("host").alias("source_server"), F.col("watermark").cast("timestamp_ntz").alias("watermark")
    )


@query("""
SELECT 'orders' AS source_table, 'srv-' || o_orderstatus AS source_server, count(*) AS rows, CAST(sum(o_custkey) AS BIGINT) AS checksum FROM orders GROUP BY ALL
UNION ALL
SELECT 'events', CASE WHEN user_id % 3 = 0 THEN 'srv-B' ELSE 'srv-A' END, count(*), CAST(sum(user_id) AS BIGINT) FROM events GROUP BY ALL
""")
def medallion_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables from five servers, landed, enriched and conformed side by side."""
    lake = Medallion(spark, scratch_path(spark, "parallel"))
    orders = table(spark, sf_dir, "orders").withColumn("loaded", F.trunc("o_orderdate", "year").cast("timestamp_ntz"))
    events = table(spark, sf_dir, "events").withColumn("loaded", _week("ts"))
    sales = TableSpec("", "sales", "dbo", "orders", ("o_orderkey",), "loaded")
    specs = [replace(sales, host=f"srv-{status}") for status in "FOP"] + _both_servers(EVENTS)

    def read(spec: TableSpec) -> DataFrame:
        if spec.table == "orders":
            return orders.where(F.col("o_orderstatus") == spec.host[-1])
        return events.where((EARLY if spec.host == "srv-A" else LATE).format("user_id"))

    lake.land_all(specs, read)
    lake.bronze_all(specs, AS_OF)
    lake.silver_all(specs)
    parts = [
        lake.read_silver(spec).groupBy(F.lit(spec.table).alias("source_table"), F.col(S.SOURCE_SERVER).alias("source_server"))
        .agg(F.count("*").alias("rows"), F.sum(key).alias("checksum"))
        for spec, key in ((specs[0], "o_custkey"), (specs[-1], "user_id"))
    ]
    return parts[0].unionByName(parts[1])
