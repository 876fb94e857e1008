"""Flows that check their rows as they load them: measures, rows kept apart, parity from the log, retention."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.flows import ORDERS
from tidemark.catalog.layers import AS_OF
from tidemark.catalog.registry import query, table
from tidemark.operators import measures
from tidemark.plans.medallion import Medallion
from tidemark.session import scratch_path
from tidemark.sources import landing
from tidemark.spec import TableSpec

RULES = (
    ("not open", "o_orderstatus <> 'O'"),
    ("priority known", "o_orderpriority IS NOT NULL"),
    ("large", "o_totalprice >= 1000"),
)
SPEC = replace(ORDERS, host="srv-A", watermark="loaded", rules=RULES)
HALVES = ("o_orderkey % 2 = 0", "o_orderkey % 2 = 1")

_CHECKED = """
src AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, nullif(o_orderpriority, '5-LOW') AS o_orderpriority, o_orderdate,
               CAST(date_trunc('year', o_orderdate) AS TIMESTAMP) AS loaded FROM orders),
checked AS (SELECT *, coalesce(o_orderstatus <> 'O', false) AS a, o_orderpriority IS NOT NULL AS b, coalesce(o_totalprice >= 1000, false) AS c FROM src)"""


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"), "o_orderdate",
        F.trunc("o_orderdate", "year").cast("timestamp_ntz").alias("loaded"),
    )


def _two_batches(spark: SparkSession, sf_dir: str, spec: TableSpec = SPEC) -> Medallion:
    """Two landed batches, the second without the customer, brought into bronze by one load."""
    lake = Medallion(spark, scratch_path(spark, "measured"), clock=lambda: AS_OF.replace(tzinfo=timezone.utc), measured=True)
    source = _source(spark, sf_dir)
    lake.land(spec, source.where(HALVES[0]), datetime(2024, 2, 1))
    lake.land(spec, source.where(HALVES[1]).drop("o_custkey"), datetime(2024, 2, 2))
    lake.bronze(spec, AS_OF)
    return lake


_COLUMNS = ("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate", "loaded")


@query(f"""WITH {_CHECKED}
SELECT 'rows' AS measure, CAST(NULL AS VARCHAR) AS name, count(*) AS value FROM checked
UNION ALL SELECT 'rejected', NULL, count(*) FILTER (WHERE NOT (a AND b AND c)) FROM checked
UNION ALL SELECT 'broken', 'not open', count(*) FILTER (WHERE NOT a) FROM checked
UNION ALL SELECT 'broken', 'priority known', count(*) FILTER (WHERE NOT b) FROM checked
UNION ALL SELECT 'broken', 'large', count(*) FILTER (WHERE NOT c) FROM checked
UNION ALL SELECT 'nulls', 'o_custkey', count(*) FILTER (WHERE o_custkey IS NULL OR o_orderkey % 2 = 1) FROM checked
{' '.join(f"UNION ALL SELECT 'nulls', '{c}', count(*) - count({c}) FROM checked" for c in _COLUMNS)}
""")
def measures_of_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a bronze load wrote down in passing: rows, nulls per column, rows per broken rule."""
    written = _two_batches(spark, sf_dir).read_measures()
    return written.where(F.col("layer") == "bronze").select("measure", "name", "value")


@query(f"""WITH {_CHECKED}
SELECT * EXCLUDE (o_custkey, a, b, c), CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 2 = 0 THEN 'orders_2024-02-01T00-00-00.000000Z' ELSE 'orders_2024-02-02T00-00-00.000000Z' END AS batch_id,
       concat_ws(', ', CASE WHEN NOT a THEN 'not open' END, CASE WHEN NOT b THEN 'priority known' END, CASE WHEN NOT c THEN 'large' END) AS broken
FROM checked WHERE NOT (a AND b AND c)
""")
def rows_kept_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that broke a rule on their way into bronze, with the rules and the batch they came in."""
    apart = _two_batches(spark, sf_dir).read_quarantine(SPEC)
    return apart.withColumn("broken", F.array_join(measures.BROKEN, ", ")).drop(measures.BROKEN)


@query(f"""WITH {_CHECKED}
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate
FROM checked WHERE a AND b AND c
""")
def rows_that_pass_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What bronze holds beside them."""
    bronze = _two_batches(spark, sf_dir).read_bronze(SPEC)
    return bronze.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate")


@query(f"""WITH {_CHECKED}
SELECT 'rows' AS measure, '' AS name, count(*) AS expected, count(*) AS found, true AS ok FROM checked
UNION ALL SELECT 'nulls', 'o_custkey', n, n, true FROM (SELECT count(*) FILTER (WHERE o_custkey IS NULL OR o_orderkey % 2 = 1) AS n FROM checked)
{' '.join(f"UNION ALL SELECT 'nulls', '{c}', count(*) - count({c}), count(*) - count({c}), true FROM checked" for c in _COLUMNS)}
""")
def layer_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and nulls per column of landing and bronze, compared from what their loads wrote down."""
    return _two_batches(spark, sf_dir, replace(SPEC, rules=())).parity().drop("source", "batches")


@query("""
SELECT user_id, event_type, value, ts, CAST(date_trunc('month', ts) AS DATE) AS "__PartitionDateUTC", event_id,
       'events_2024-02-03T00-00-00.000000Z' AS batches_left
FROM events
""")
def bronze_with_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of a flow that keeps one: bronze holds the rows of all, landing the newest."""
    spec = TableSpec("srv-A", "web", "dbo", "events", ("event_id",), "loaded")
    lake = Medallion(spark, scratch_path(spark, "kept"), keep_batches=1)
    events = table(spark, sf_dir, "events").withColumn("loaded", F.date_trunc("month", "ts").cast("timestamp_ntz"))
    for number in range(3):
        lake.land(spec, events.where(F.col("event_id") % 3 == number), datetime(2024, 2, 1 + number))
        lake.bronze(spec, AS_OF)
    lake.compact_logs(more_than=1)
    left = ", ".join(landing.landed_batches(spark, lake.path("landing", spec)))
    rows = lake.read_bronze(spec).select("user_id", "event_type", "value", "ts", "__PartitionDateUTC", "event_id")
    return rows.withColumn("batches_left", F.lit(left))
