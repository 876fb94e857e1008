"""Bronze enrichment, watermarks, batches, conforming unions and upserts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import spec as S
from tidemark.catalog.registry import query, table
from tidemark.functions.temporal import at_zone, timestamps_to_dates
from tidemark.operators import upsert as U
from tidemark.operators import watermarks as W
from tidemark.operators.conform import conform_union
from tidemark.operators.enrich import add_lineage
from tidemark.sources.landing import latest_batch, pending_batches as find_pending
from tidemark.spec import LoadType, TableSpec

AS_OF = datetime(2024, 7, 1, 12, 0, 0)

ORDERS = TableSpec("srv", "sales", "dbo", "orders", ("o_orderkey", "o_orderdate"), "o_orderdate")
CUSTOMERS = TableSpec("srv-crm", "crm", "dbo", "customer", ("c_custkey",), load_type=LoadType.FULL)


def server() -> Column:
    return F.concat(F.lit("srv-"), F.col("o_orderstatus"))


def naive_records(df: DataFrame) -> DataFrame:
    """Record timestamps as wall-clock values, which compare the same in every engine."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in (S.CREATED_UTC, S.CREATED_CENTRAL)})


@query("""
SELECT *, CAST(o_orderdate AS DATE) AS "__PartitionDateUTC",
       sha256(concat_ws(' ', CAST(o_orderkey AS VARCHAR), CAST(o_orderdate AS VARCHAR), 'srv-' || o_orderstatus)) AS "__hash_key",
       TIMESTAMP '2024-07-01 12:00:00' AS "__record_created_datetime_utc",
       TIMESTAMP '2024-07-01 07:00:00' AS "__record_created_datetime_cst",
       'srv-' || o_orderstatus AS "__source_server", 'sales' AS "__source_database", 'dbo.orders' AS "__source_table"
FROM orders
""")
def bronze_lineage_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive_records(add_lineage(table(spark, sf_dir, "orders"), ORDERS, AS_OF, host=server()))


@query("""
SELECT *, sha256(concat_ws(' ', CAST(c_custkey AS VARCHAR), 'srv-crm')) AS "__hash_key",
       TIMESTAMP '2024-07-01 12:00:00' AS "__record_created_datetime_utc",
       TIMESTAMP '2024-07-01 07:00:00' AS "__record_created_datetime_cst",
       'srv-crm' AS "__source_server", 'crm' AS "__source_database", 'dbo.customer' AS "__source_table"
FROM customer
""")
def bronze_lineage_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive_records(add_lineage(table(spark, sf_dir, "customer"), CUSTOMERS, AS_OF))


@query("""
WITH moved AS (SELECT event_id, ts + to_days(CAST(event_id % 366 AS INTEGER)) AS utc FROM events),
bounds AS (SELECT *, make_date(year(utc), 3, 8) AS m, make_date(year(utc), 11, 1) AS n FROM moved)
SELECT event_id, utc,
       CASE WHEN utc >= CAST(m + CAST((7 - dayofweek(m)) % 7 AS INTEGER) AS TIMESTAMP) + INTERVAL 8 HOUR
             AND utc < CAST(n + CAST((7 - dayofweek(n)) % 7 AS INTEGER) AS TIMESTAMP) + INTERVAL 7 HOUR
            THEN utc - INTERVAL 5 HOUR ELSE utc - INTERVAL 6 HOUR END AS central
FROM bounds
""")
def utc_to_central(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events spread over a year, so that both sides of the clock change occur."""
    utc = (F.col("ts") + F.make_dt_interval((F.col("event_id") % 366).cast("int"))).cast("timestamp")
    moved = table(spark, sf_dir, "events").select("event_id", utc.alias("utc"))
    return moved.select(
        "event_id", F.col("utc").cast("timestamp_ntz").alias("utc"), at_zone("utc").cast("timestamp_ntz").alias("central")
    )


@query("SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-06-01 00:00:00'")
def watermark_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.filter_since(table(spark, sf_dir, "orders"), "o_orderdate", datetime(1998, 6, 1))


@query("SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1998-06-01' - 2")
def lookback_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.filter_lookback(table(spark, sf_dir, "orders"), "o_orderdate", datetime(1998, 6, 1, 13, 30))


@query("""
SELECT event_type AS "__source_server", 'web' AS "__source_database", 'dbo.events' AS "__source_table",
       date_trunc('second', max(ts)) AS watermark
FROM events GROUP BY event_type
""")
def batch_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = table(spark, sf_dir, "events").select(
        "ts",
        F.col("event_type").alias(S.SOURCE_SERVER),
        F.lit("web").alias(S.SOURCE_DATABASE),
        F.lit("dbo.events").alias(S.SOURCE_TABLE),
    )
    return W.batch_watermarks(tagged, "ts")


def _order_watermarks(orders: DataFrame, host: Column, days: Column) -> DataFrame:
    """Watermarks per host of all orders, each moved by a number of days."""
    stamp = (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(days)).cast("timestamp_ntz")
    sources = orders.select(
        host.alias("host"), F.lit("sales").alias("database"), F.lit("orders").alias("table"), stamp.alias("stamp")
    )
    return W.batch_watermarks(sources, "stamp", ("host", "database", "table"))


@query("""
WITH per_host AS (SELECT o_orderstatus, max(o_orderdate - CASE WHEN o_orderstatus = 'P' THEN INTERVAL 730 DAY
                                            ELSE INTERVAL 0 DAY END) AS watermark FROM orders GROUP BY o_orderstatus)
SELECT 'orders' AS "table", min(watermark) AS watermark FROM per_host
""")
def watermark_min_over_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One server lags two years behind the others."""
    lag = F.when(F.col("o_orderstatus") == "P", -730).otherwise(0)
    return W.earliest_watermark(_order_watermarks(table(spark, sf_dir, "orders"), server(), lag))


@query("""
WITH state AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 'srv-F' ELSE 'srv-O' END AS host, max(o_orderdate) AS w
               FROM orders GROUP BY ALL),
staged AS (SELECT 'srv-' || o_orderstatus AS host, max(o_orderdate + CASE o_orderstatus WHEN 'F' THEN INTERVAL 30 DAY
             WHEN 'O' THEN INTERVAL (-730) DAY ELSE INTERVAL 0 DAY END) AS w FROM orders GROUP BY ALL)
SELECT coalesce(a.host, b.host) AS host, 'sales' AS database, 'orders' AS "table", greatest(a.w, b.w) AS watermark
FROM state a FULL JOIN staged b ON a.host = b.host
""")
def watermark_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A server that moved on, one whose staged value is older than the state's, and one that is new."""
    orders, status = table(spark, sf_dir, "orders"), F.col("o_orderstatus")
    known = F.when(status == "F", "srv-F").otherwise("srv-O")
    state = _order_watermarks(orders, known, F.lit(0))
    moved = F.when(status == "F", 30).when(status == "O", -730).otherwise(0)
    return W.commit_watermarks(state, _order_watermarks(orders, server(), moved))


@query("""
WITH batches AS (SELECT DISTINCT 'srv-' || o_orderstatus AS source, strftime(o_orderdate, '%Y-%m') AS batch_id FROM orders),
ledger AS (SELECT *, CASE WHEN batch_id LIKE '%-02' THEN 'failed' ELSE 'processed' END AS status
           FROM batches WHERE batch_id < '1998-01')
SELECT source, batch_id FROM batches b
WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.source = b.source AND l.batch_id = b.batch_id AND l.status = 'processed')
""")
def pending_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch per server and month; months before 1998 are done, except that every February failed."""
    batches = table(spark, sf_dir, "orders").select(server().alias("source"), _month().alias("batch_id")).distinct()
    failed = F.col("batch_id").endswith("-02")
    ledger = batches.where(F.col("batch_id") < "1998-01").withColumn(
        "status", F.when(failed, "failed").otherwise("processed")
    )
    return find_pending(batches, ledger)


def _month():
    return F.date_format("o_orderdate", "yyyy-MM")


@query("""
SELECT *, strftime(o_orderdate, '%Y-%m') AS batch_id FROM orders
WHERE strftime(o_orderdate, '%Y-%m') = (SELECT max(strftime(o_orderdate, '%Y-%m')) FROM orders)
""")
def latest_landed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_batch(table(spark, sf_dir, "orders").withColumn("batch_id", _month()))


@query("""
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       NULL::VARCHAR AS o_orderpriority, NULL::VARCHAR AS region_code FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, CAST(o_custkey AS VARCHAR), o_orderstatus, NULL, o_orderdate, o_orderpriority, NULL
FROM orders WHERE o_orderstatus = 'O'
UNION ALL
SELECT o_orderkey, CAST(o_custkey AS VARCHAR), o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       'r' || CAST(o_custkey % 5 AS VARCHAR) FROM orders WHERE o_orderstatus = 'P'
""")
def conform_servers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three servers: one lacks a column, one lacks another and stores a key as text, one has an extra column."""
    orders = table(spark, sf_dir, "orders")
    per_server = {s: orders.where(F.col("o_orderstatus") == s) for s in ("F", "O", "P")}
    return conform_union(
        [
            per_server["F"].drop("o_orderpriority").withColumn("o_custkey", F.col("o_custkey").cast("string")),
            per_server["O"].drop("o_totalprice"),
            per_server["P"].withColumn("region_code", F.concat(F.lit("r"), (F.col("o_custkey") % 5).cast("string"))),
        ]
    )


def _between(column: str, first: str | None = None, last: str | None = None):
    condition = F.lit(True)
    if first:
        condition = condition & (F.col(column) >= F.lit(first).cast("timestamp_ntz"))
    if last:
        condition = condition & (F.col(column) < F.lit(last).cast("timestamp_ntz"))
    return condition


def _order_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A loaded table and a batch that overlaps it; the batch changes a value and brings a new column."""
    orders = table(spark, sf_dir, "orders")
    target = orders.where(_between("o_orderdate", last="1999-07-01"))
    source = orders.where(_between("o_orderdate", first="1999-01-01")).withColumns(
        {"o_orderpriority": F.lit("CHANGED"), "batch": F.lit(2)}
    )
    return target, source


_UPSERT_SQL = """
WITH target AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-07-01'),
source AS (SELECT * REPLACE ('CHANGED' AS o_orderpriority), 2 AS batch FROM orders
           WHERE o_orderdate >= TIMESTAMP '1999-01-01')
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN s.batch IS NULL THEN t.o_custkey ELSE s.o_custkey END AS o_custkey,
       CASE WHEN s.batch IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.batch IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
       CASE WHEN s.batch IS NULL THEN t.o_orderdate ELSE s.o_orderdate END AS o_orderdate,
       CASE WHEN s.batch IS NULL THEN t.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority, s.batch
FROM target t FULL JOIN source s ON t.o_orderkey = s.o_orderkey
"""


@query(_UPSERT_SQL)
def upsert_single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _order_batch(spark, sf_dir)
    return U.upsert(target, source, ["o_orderkey"])


@query(_UPSERT_SQL)
def upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that is delivered twice."""
    target, source = _order_batch(spark, sf_dir)
    once = U.upsert(target, source, ["o_orderkey"], on_duplicate="keep")
    return U.upsert(once, source, ["o_orderkey"], on_duplicate="keep")


@query("""
WITH keyed AS (SELECT event_id, nullif(user_id % 40, 0) AS user_part, CAST(ts AS DATE) AS day, ts, value FROM events),
target AS (SELECT *, 'old' AS origin FROM keyed WHERE ts < TIMESTAMP '2024-01-20'),
source AS (SELECT *, 'new' AS origin FROM keyed WHERE ts >= TIMESTAMP '2024-01-10')
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s
    WHERE s.event_id = t.event_id AND s.user_part = t.user_part AND s.day = t.day)
UNION ALL SELECT * FROM source
""")
def upsert_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three key columns, one of them sometimes null: such rows never match and are inserted again."""
    keyed = table(spark, sf_dir, "events").select(
        "event_id", F.nullif(F.col("user_id") % 40, F.lit(0)).alias("user_part"), F.to_date("ts").alias("day"), "ts", "value"
    )
    target = keyed.where(_between("ts", last="2024-01-20")).withColumn("origin", F.lit("old"))
    source = keyed.where(_between("ts", first="2024-01-10")).withColumn("origin", F.lit("new"))
    return U.upsert(target, source, ["event_id", "user_part", "day"], on_duplicate="keep")


@query("""
SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-07-01'
UNION ALL
SELECT * REPLACE ('CHANGED' AS o_orderpriority) FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01'
""")
def insert_only_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _order_batch(spark, sf_dir)
    return U.insert_only(target, source.drop("batch"), ["o_orderkey"])


@query("""
SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
             l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1
""")
def dedupe_latest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.dedupe_latest(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS "rows" FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def duplicate_source_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem")
def dates_from_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timestamps_to_dates(table(spark, sf_dir, "lineitem"))
