"""Data-quality checks over tables with planted defects, and run-log rows."""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog.registry import query, table
from tidemark.operators import quality, runlog
from tidemark.operators.enrich import add_lineage
from tidemark.session import scratch_path
from tidemark.sources import tables
from tidemark.spec import LoadType, TableSpec


def _layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A table and a copy of it with another type, moved nulls, a missing column and a missing part."""
    orders = table(spark, sf_dir, "orders")
    left = orders.withColumn("o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    right = orders.where(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.nullif(F.col("o_custkey") % 10, F.lit(3)).alias("o_custkey"),
        "o_orderstatus",
        "o_orderdate",
        "o_orderpriority",
    )
    return left, right


_LAYERS = """
l AS (SELECT * REPLACE (nullif(o_orderpriority, '5-LOW') AS o_orderpriority) FROM orders),
r AS (SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, nullif(o_custkey % 10, 3) AS o_custkey, o_orderstatus, o_orderdate,
             o_orderpriority FROM orders WHERE o_orderstatus <> 'P')"""

_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def _nulls_sql(side: str, column: str) -> str:
    return f"(SELECT count(*) - count({column}) FROM {side})"


@query(f"""WITH {_LAYERS} SELECT (SELECT count(*) FROM l) AS left_rows, (SELECT count(*) FROM r) AS right_rows,
(SELECT count(*) FROM l) = (SELECT count(*) FROM r) AS ok""")
def dq_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.count_parity(*_layers(spark, sf_dir))


@query(f"WITH {_LAYERS} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {_nulls_sql('l', c)} AS nulls" for c in _COLUMNS))
def dq_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_profile(_layers(spark, sf_dir)[0])


def _parity_sql() -> str:
    right = {c: _nulls_sql("r", c) if c != "o_totalprice" else "CAST(NULL AS BIGINT)" for c in _COLUMNS}
    rows = [f"SELECT '{c}' AS c, {_nulls_sql('l', c)} AS ln, {right[c]} AS rn" for c in _COLUMNS]
    return f"""WITH {_LAYERS}, sides AS ({' UNION ALL '.join(rows)})"""


@query(f"""{_parity_sql()} SELECT c AS "column", ln AS left_nulls, rn AS right_nulls, ln IS NOT DISTINCT FROM rn AS ok FROM sides""")
def dq_null_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_parity(*_layers(spark, sf_dir))


@query(f"""{_parity_sql()} SELECT CAST(sum(ln) AS BIGINT) AS left_nulls, CAST(sum(rn) AS BIGINT) AS right_nulls,
sum(ln) = sum(rn) AS ok FROM sides""")
def dq_total_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.total_null_parity(*_layers(spark, sf_dir))


@query(f"""{_parity_sql()} SELECT c AS "column", ln AS left_nulls, rn AS right_nulls, ln = 0 AND rn = 0 AS ok
FROM sides WHERE c IN ('o_orderkey', 'o_custkey')""")
def dq_pk_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_keys(*_layers(spark, sf_dir), ["o_orderkey", "o_custkey"])


@query(f"""{_parity_sql()} SELECT c AS "column", ln AS left_nulls, rn AS right_nulls,
  CASE c WHEN 'o_orderkey' THEN 'bigint' ELSE 'double' END AS left_type,
  CASE c WHEN 'o_orderkey' THEN 'string' END AS right_type
FROM sides WHERE c IN ('o_orderkey', 'o_totalprice')""")
def dq_dtype_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns whose types differ, with the null counts of both sides."""
    left, right = _layers(spark, sf_dir)
    differing = quality.type_differences(left, right)
    return differing.join(quality.null_parity(left, right).drop("ok"), "column", "left")


START, END = datetime(2024, 7, 1, 12, 0, 0), datetime(2024, 7, 1, 12, 1, 30)


@query("""
WITH per_host AS (SELECT CASE WHEN o_orderstatus = 'P' THEN 'Failed' ELSE 'Success' END AS status, count(*) AS n,
                         max(o_orderdate) AS last FROM orders GROUP BY o_orderstatus)
SELECT TIMESTAMP '2024-07-01 12:00:00' AS start_datetime_utc, TIMESTAMP '2024-07-01 12:01:30' AS end_datetime_utc,
       'incremental' AS load_type, CAST(NULL AS VARCHAR) AS source_server, CAST(NULL AS VARCHAR) AS source_database,
       'orders' AS source_table, 'silver' AS medallion_layer, 'silver/orders' AS data_lake_path,
       CAST(90 AS FLOAT) AS load_execution_time, status AS notebook_execution_status,
       CAST(sum(n) AS BIGINT) AS records_inserted, max(last) AS last_record_inserted_datetime
FROM per_host GROUP BY status
""")
def run_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for the servers that succeeded and one for those that failed."""
    failed = F.col("o_orderstatus") == "P"
    per_source = (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderstatus")
        .agg(F.count("*").alias("rows"), F.max("o_orderdate").alias("last"))
        .withColumn("status", F.when(failed, runlog.FAILED).otherwise(runlog.SUCCESS))
    )
    rows = runlog.consolidated(per_source, "orders", "silver", "silver/orders", START, END, LoadType.INCREMENTAL)
    stamps = ("start_datetime_utc", "end_datetime_utc", "last_record_inserted_datetime")
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


@query("""
SELECT 'system columns added' AS change, true AS equal, count(*) AS rows FROM orders
UNION ALL SELECT 'key as text', false, count(*) FROM orders
UNION ALL SELECT 'column missing', false, count(*) FROM orders
""")
def dq_schema_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema equality of two layers, with the rows it was asked for."""
    orders = table(spark, sf_dir, "orders")
    spec = TableSpec("srv", "sales", "dbo", "orders", ("o_orderkey",), "o_orderdate")
    changed = {
        "system columns added": add_lineage(orders, spec),
        "key as text": orders.withColumn("o_orderkey", F.col("o_orderkey").cast("string")),
        "column missing": orders.drop("o_custkey"),
    }
    rows = orders.agg(F.count("*").alias("rows"))
    found = [
        rows.select(F.lit(name).alias("change"), F.lit(quality.same_schema(orders, other)).alias("equal"), "rows")
        for name, other in changed.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query("""
SELECT 'o_orderkey' AS "column", 'bigint' AS left_type, 'string' AS right_type, count(*) AS left_rows FROM orders
UNION ALL SELECT 'o_totalprice', 'double', NULL, count(*) FROM orders
""")
def dq_catalog_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types that differ between two registered tables, from the catalog, with the rows of the first."""
    left, right = _layers(spark, sf_dir)
    names = [f"typed_{uuid.uuid4().hex}" for _ in range(2)]
    for name, df in zip(names, (left, right)):
        path = scratch_path(spark, name)
        tables.write_snapshot(df, path)
        tables.register_table(spark, name, path)
    rows = quality.row_count(spark.table(f"default.{names[0]}"))
    differing = quality.catalog_type_differences(spark, *[f"default.{n}" for n in names])
    return differing.withColumn("left_rows", F.lit(rows).cast("long"))


@query("SELECT o_orderkey, o_custkey % 10 AS tenth, o_orderstatus FROM orders")
def managed_table_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A managed table made from a query and replaced by a wider one, read by its name."""
    name = f"managed_{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 10).alias("tenth"), "o_orderstatus")
    tables.replace_managed_table(orders.where("o_orderstatus = 'F'").drop("tenth"), name)
    tables.replace_managed_table(orders, name)
    return spark.table(f"default.{name}")
