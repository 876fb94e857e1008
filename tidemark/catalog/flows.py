"""Whole dataflows that write to and read from the shared scratch folder."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import spec as S
from tidemark.catalog.layers import AS_OF, _order_batch, naive_records
from tidemark.catalog.registry import query, table
from tidemark.plans.fact import FactSpec
from tidemark.plans.medallion import Medallion
from tidemark.session import scratch_path
from tidemark.sources import landing, tables
from tidemark.spec import LoadType, TableSpec
from tidemark.streaming.ingest import stream_to_bronze

SERVERS = {"F": "srv-F", "O": "srv-O", "P": "srv-P"}
DRIFT = {"F": "o_orderpriority", "O": "o_totalprice", "P": None}
ORDERS = TableSpec("", "sales", "dbo", "orders", ("o_orderkey",), "o_orderdate")

_LOADED = """CAST(date_trunc('year', o_orderdate) AS DATE)
             + CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 1 ELSE 0 END"""

_SILVER = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_totalprice END AS o_totalprice,
       o_orderdate, CASE WHEN o_orderstatus = 'F' THEN NULL
                         WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 'CHANGED' ELSE o_orderpriority END AS o_orderpriority,
       CAST(loaded AS TIMESTAMP) AS loaded, loaded AS "__PartitionDateUTC",
       sha256(concat_ws(' ', CAST(o_orderkey AS VARCHAR), 'srv-' || o_orderstatus)) AS "__hash_key",
       TIMESTAMP '2024-07-01 12:00:00' AS "__record_created_datetime_utc",
       TIMESTAMP '2024-07-01 07:00:00' AS "__record_created_datetime_cst",
       'srv-' || o_orderstatus AS "__source_server", 'sales' AS "__source_database", 'dbo.orders' AS "__source_table"
FROM (SELECT *, {_LOADED} AS loaded FROM orders)
"""


def _yearly(spec: TableSpec) -> TableSpec:
    return replace(spec, watermark="loaded")


def _loaded(orders: DataFrame, batch: int) -> DataFrame:
    """Load time per row: the batch's day of the order's year.

    Few distinct days keep the small test tables from splintering; the second batch is later than the first, so its
    rows pass the watermark and change partition.
    """
    return orders.withColumn("loaded", F.date_add(F.trunc("o_orderdate", "year"), batch).cast("timestamp_ntz"))


@query(_SILVER)
def medallion_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three drifting servers, two overlapping batches through landing, bronze and silver.  Equal to one full run."""
    lake = Medallion(spark, scratch_path(spark, "medallion"))
    specs = [_yearly(replace(ORDERS, host=host)) for host in SERVERS.values()]
    first, second = _order_batch(spark, sf_dir)
    for number, batch in enumerate([first, second.drop("batch")]):
        moment = datetime(2024, 7, 1 + number)

        def pull(spec: TableSpec, batch=batch, number=number) -> DataFrame:
            status = spec.host[-1]
            rows = _loaded(batch.where(F.col("o_orderstatus") == status), number)
            return rows.drop(DRIFT[status]) if DRIFT[status] else rows

        for spec in specs:
            lake.land(spec, pull(spec), moment)
        lake.bronze_all(specs, AS_OF)
        lake.silver(specs)
        lake.commit()
    return naive_records(lake.read_silver(specs[0]))


_UPSERTED = """
SELECT * REPLACE (CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 'CHANGED' ELSE o_orderpriority END AS o_orderpriority),
  CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 2 END AS batch,
  CAST(date_trunc('year', o_orderdate) AS DATE) + CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 1 ELSE 0 END AS part
FROM orders
"""


@query(_UPSERTED)
def upsert_moving_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In-place upsert of a partitioned table in which changed rows move to another partition."""
    path = scratch_path(spark, "upsert")
    target, source = _order_batch(spark, sf_dir)
    year = F.to_date(F.date_trunc("year", "o_orderdate"))
    tables.upsert_partitions(spark, path, target.withColumn("part", year), ["o_orderkey"], "part")
    tables.upsert_partitions(spark, path, source.withColumn("part", F.date_add(year, 1)), ["o_orderkey"], "part")
    return tables.read_partitioned(spark, path)


@query("SELECT * FROM customer")
def snapshot_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full load: silver snapshot, copied to gold, read back through its catalog entry's location."""
    root = scratch_path(spark, "promote")
    tables.write_snapshot(table(spark, sf_dir, "customer"), f"{root}/silver/customer")
    tables.promote(spark, f"{root}/silver/customer", f"{root}/gold/customer")
    return tables.read_table(spark, f"{root}/gold/customer", "snapshot")


@query("""
SELECT *, sha256(concat_ws(' ', CAST(c_custkey AS VARCHAR), 'srv-crm')) AS "__hash_key",
       TIMESTAMP '2024-07-01 12:00:00' AS "__record_created_datetime_utc",
       TIMESTAMP '2024-07-01 07:00:00' AS "__record_created_datetime_cst",
       'srv-crm' AS "__source_server", 'crm' AS "__source_database", 'dbo.customer' AS "__source_table"
FROM customer
""")
def medallion_full_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full-load table: the newest of two landed pulls replaces what was there, then silver and gold."""
    lake = Medallion(spark, scratch_path(spark, "full"))
    spec = TableSpec("srv-crm", "crm", "dbo", "customer", ("c_custkey",), load_type=LoadType.FULL)
    customers = table(spark, sf_dir, "customer")
    lake.land(spec, customers.where(F.col("c_acctbal") > 0), datetime(2024, 7, 1))
    lake.land(spec, customers, datetime(2024, 7, 2))
    lake.bronze(spec, AS_OF)
    lake.silver([spec])
    lake.promote([spec.table])
    return naive_records(tables.read_snapshot(spark, lake.path("gold", spec.table)))


@query(f"""
SELECT *, CAST(loaded AS DATE) AS "__PartitionDateUTC",
       sha256(concat_ws(' ', CAST(o_orderkey AS VARCHAR), 'srv-A')) AS "__hash_key",
       TIMESTAMP '2024-07-01 12:00:00' AS "__record_created_datetime_utc",
       TIMESTAMP '2024-07-01 07:00:00' AS "__record_created_datetime_cst",
       'srv-A' AS "__source_server", 'sales' AS "__source_database", 'dbo.orders' AS "__source_table"
FROM (SELECT * REPLACE (CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN 'CHANGED' ELSE o_orderpriority END
                        AS o_orderpriority), CAST({_LOADED} AS TIMESTAMP) AS loaded FROM orders)
""")
def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landed batches taken up by two runs of a stream that stops when it has caught up."""
    root = scratch_path(spark, "stream")
    spec = _yearly(replace(ORDERS, host="srv-A"))
    first, second = _order_batch(spark, sf_dir)
    for number, batch in enumerate([first, second.drop("batch")]):
        rows = _loaded(batch, number)
        landing.land(rows, f"{root}/landing", landing.batch_name("orders", datetime(2024, 7, 1 + number)))
        run = stream_to_bronze(spark, spec, f"{root}/landing", rows.schema, f"{root}/bronze", f"{root}/checkpoint", AS_OF)
        run.awaitTermination()
    return naive_records(tables.read_partitioned(spark, f"{root}/bronze"))



NOTED = FactSpec(
    keys=("event_id",),
    base={c: c for c in ("event_id", "user_id", "ts", "event_type", S.PARTITION_DATE)},
    attributes={"amount": "value", "details": "props"},
    nullable_keys=False,
)


@query("""
SELECT CAST(e.event_id AS VARCHAR) AS "Fact_ID", sha256(CAST(e.event_id AS VARCHAR)) AS "HashKey", e.event_id, e.user_id,
       e.ts, e.event_type, CAST(date_trunc('week', e.ts) AS DATE) AS "__PartitionDateUTC", a.event_id AS "callId", a.value AS amount,
       a.props AS details
FROM events e LEFT JOIN events a ON a.event_id = e.event_id AND a.event_id % 3 <> 0
""")
def gold_fact_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes arrive three days after their base row, many of them one batch later.  Equal to one full join."""
    lake = Medallion(spark, scratch_path(spark, "gold"))
    events = TableSpec("srv", "web", "dbo", "events", ("event_id",), "loaded")
    notes = replace(events, table="notes")
    source = table(spark, sf_dir, "events")

    def week(stamp: Column) -> Column:
        return F.date_trunc("week", stamp).cast("timestamp_ntz").alias("loaded")

    rows = source.select("event_id", "user_id", "ts", "event_type", week(F.col("ts")))
    details = source.where(F.col("event_id") % 3 != 0).select(
        "event_id", "value", "props", week(F.col("ts") + F.expr("INTERVAL 3 DAYS"))
    )
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    for number, batch in enumerate([F.col("loaded") < cut, F.col("loaded") >= cut]):
        for spec, df in ((events, rows), (notes, details)):
            lake.land(spec, df.where(batch), datetime(2024, 2, 1 + number))
            lake.bronze(spec, AS_OF)
            lake.silver([spec])
        lake.fact("fact_events", events, notes, NOTED, ["Fact_ID", "event_id"], S.PARTITION_DATE)
        lake.commit()
    return tables.read_partitioned(spark, lake.path("gold", "fact_events"))


@query("""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'moved' ELSE event_type END AS state,
       CASE WHEN event_id % 3 = 0 THEN 'all/' || user_id % 3 ELSE event_type || ':' || user_id % 3 || '/x y%' END AS part
FROM events
""")
def upsert_odd_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition values that have to be escaped; a third of the keys moves to other partitions."""
    path = scratch_path(spark, "odd")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("event_type").alias("state"))
    third = (F.col("user_id") % 3).cast("string")
    first = events.withColumn("part", F.concat("state", F.lit(":"), third, F.lit("/x y%"))).drop("user_id")
    moved = events.where("event_id % 3 = 0").select(
        "event_id", F.lit("moved").alias("state"), F.concat(F.lit("all/"), third).alias("part")
    )
    tables.upsert_partitions(spark, path, first, ["event_id"], "part")
    tables.upsert_partitions(spark, path, moved, ["event_id"], "part")
    return tables.read_partitioned(spark, path)


@query("SELECT event_id, value, event_id % 2 = 0 OR event_id % 5 = 0 AS part FROM events")
def upsert_boolean_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys move between the two partitions of a boolean."""
    path = scratch_path(spark, "boolean")
    events = table(spark, sf_dir, "events").select("event_id", "value", (F.col("event_id") % 2 == 0).alias("part"))
    tables.upsert_partitions(spark, path, events, ["event_id"], "part")
    moved = events.where("event_id % 5 = 0").withColumn("part", F.lit(True))
    tables.upsert_partitions(spark, path, moved, ["event_id"], "part")
    return tables.read_partitioned(spark, path)


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END AS reference,
       year(o_orderdate) AS part FROM orders
""")
def upsert_type_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column of numbers becomes text when a later batch brings text: the stored partitions are rewritten once."""
    path = scratch_path(spark, "drift")
    orders = table(spark, sf_dir, "orders").withColumn("part", F.year("o_orderdate").cast("long"))
    first = orders.select("o_orderkey", F.col("o_custkey").alias("reference"), "part")
    second = orders.where("o_orderkey % 4 = 0").select("o_orderkey", F.col("o_orderpriority").alias("reference"), "part")
    tables.upsert_partitions(spark, path, first, ["o_orderkey"], "part")
    tables.upsert_partitions(spark, path, second, ["o_orderkey"], "part")
    return tables.read_partitioned(spark, path)


@query("""
SELECT user_id, event_id, value, user_id % 7 AS part FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
""")
def upsert_latest_duplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several source rows of one key: a user's last event wins."""
    path = scratch_path(spark, "latest")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "value", (F.col("user_id") % 7).alias("part"))
    tables.upsert_partitions(spark, path, events, ["user_id"], "part", on_duplicate="latest", order=["event_id"])
    return tables.read_partitioned(spark, path)


@query("""
SELECT CAST(e.event_id AS VARCHAR) AS "Fact_ID", sha256(CAST(e.event_id AS VARCHAR)) AS "HashKey", e.event_id, e.user_id,
       e.ts, e.event_type, CAST(date_trunc('week', e.ts) AS DATE) AS "__PartitionDateUTC", a.event_id AS "callId", a.value AS amount,
       a.props AS details
FROM events e LEFT JOIN events a ON a.event_id = e.event_id AND a.event_id % 3 <> 0
""")
def gold_two_cadences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another table's flow commits between a table's silver and its gold step; the gold step still sees all its rows."""
    lake = Medallion(spark, scratch_path(spark, "cadences"))
    events = TableSpec("srv", "web", "dbo", "events", ("event_id",), "loaded")
    notes, users = replace(events, table="notes"), replace(events, table="users", keys=("user_id",))
    source = table(spark, sf_dir, "events").withColumn("loaded", F.date_trunc("week", "ts").cast("timestamp_ntz"))
    rows = source.select("event_id", "user_id", "ts", "event_type", "loaded")
    details = source.where(F.col("event_id") % 3 != 0).select("event_id", "value", "props", "loaded")
    people = source.groupBy("user_id").agg(F.max("loaded").alias("loaded"))
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    for number, batch in enumerate([F.col("loaded") < cut, F.col("loaded") >= cut]):
        for spec, df in ((events, rows), (notes, details), (users, people)):
            lake.land(spec, df.where(batch), datetime(2024, 2, 1 + number))
            lake.bronze(spec, AS_OF)
            lake.silver([spec])
            lake.commit(["users"])
        lake.fact("fact_events", events, notes, NOTED, ["Fact_ID", "event_id"], S.PARTITION_DATE)
        lake.commit(["events", "notes"])
    return tables.read_partitioned(spark, lake.path("gold", "fact_events"))


@query("""
SELECT event_id, event_type, CASE WHEN event_id % 4 = 0 THEN value END AS amount,
       CASE WHEN event_id % 4 = 0 THEN 9 ELSE user_id % 3 END AS part FROM events
""")
def catalog_follows_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered table after an upsert that brought a column, filled a partition and left others: read by its name."""
    path = scratch_path(spark, "registered")
    name = f"events_{path[-32:]}"
    events = table(spark, sf_dir, "events").withColumn("part", F.col("user_id") % 3)
    moved = events.where("event_id % 4 = 0").withColumn("part", F.lit(9).cast("long"))
    tables.upsert_partitions(spark, path, events.select("event_id", "event_type", "part"), ["event_id"], "part")
    tables.register_table(spark, name, path)
    more = moved.select("event_id", "event_type", F.col("value").alias("amount"), "part")
    tables.upsert_partitions(spark, path, more, ["event_id"], "part")
    tables.register_table(spark, name, path)
    return spark.table(f"default.{name}")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END AS reference,
       CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS o_orderstatus, loaded, CAST(loaded AS DATE) AS "__PartitionDateUTC",
       sha256(concat_ws(' ', CAST(o_orderkey AS VARCHAR), 'srv-A')) AS "__hash_key",
       TIMESTAMP '2024-07-01 12:00:00' AS "__record_created_datetime_utc",
       TIMESTAMP '2024-07-01 07:00:00' AS "__record_created_datetime_cst",
       'srv-A' AS "__source_server", 'sales' AS "__source_database", 'dbo.orders' AS "__source_table"
FROM (SELECT *, date_trunc('year', o_orderdate)::TIMESTAMP AS loaded FROM orders)
""")
def bronze_drifting_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two pending batches, of which the second has text for a number, lacks a column and brings one: bronze holds both."""
    lake = Medallion(spark, scratch_path(spark, "drifting"))
    spec = _yearly(replace(ORDERS, host="srv-A"))
    orders = _loaded(table(spark, sf_dir, "orders"), 0)
    numbers = orders.where("o_orderkey % 2 = 1").select("o_orderkey", F.col("o_custkey").alias("reference"), "o_totalprice", "loaded")
    texts = orders.where("o_orderkey % 2 = 0").select("o_orderkey", F.col("o_orderpriority").alias("reference"), "o_orderstatus", "loaded")
    for number, batch in enumerate([numbers, texts]):
        lake.land(spec, batch, datetime(2024, 7, 1 + number))
    lake.bronze(spec, AS_OF)
    return naive_records(lake.read_bronze(spec))
