"""Parquet tables: plain files, versioned snapshots, partition-scoped upserts and catalog entries.

Parquet has no MERGE and no transaction log.  Two sinks stand in for them:

* A *snapshot* table is rewritten as a whole into a new folder; a one-line pointer file then switches readers over.
  Right for dimensions, state and full loads.
* A *partitioned* table is upserted in place: only partitions that receive rows or lose rows are read in full and
  rewritten.  Right for large tables that a batch touches in few places.  New files are staged and recorded before any
  old one goes, so an interrupted upsert is finished by the next one; readers may see it half done until then.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.conform import align, all_columns, textual_conflicts
from tidemark.operators.joins import BROADCAST_ROWS, anti_join, semi_join
from tidemark.operators.upsert import OnDuplicate, checked_key_count, resolve_duplicates
from tidemark.sources import keyindex, paths
from tidemark.sources.rows import local_frame

POINTER = "_CURRENT"
SCHEMA_FILE = "_SCHEMA"
STAGED_FILE = "_STAGED"
COMPACTED_FILE = "_COMPACTED"
#: Folders of an upsert that are replaced at a time.
RENAMES = 16
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a file format, or one of the table kinds ``snapshot`` and ``partitioned``."""
    if fmt == "snapshot":
        return read_snapshot(spark, path)
    if fmt == "partitioned":
        return read_partitioned(spark, path)
    return spark.read.format(fmt).load(path)


def _writer(df: DataFrame, mode: str, partition_by: Sequence[str]):
    """Partitioned writes are rebalanced first: AQE cuts an oversized partition value into several files and packs
    small ones, instead of every task writing a sliver of every partition."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode)
    return writer.partitionBy(*partition_by) if partition_by else writer


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    _writer(df, "overwrite", partition_by).parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    if partition_by:
        keyindex.drop(df.sparkSession, path)
    _writer(df, "append", partition_by).parquet(path)


def compact(spark: SparkSession, path: str, schema: T.StructType | str, more_than: int = 1) -> int:
    """Put the many small files of an append-only folder into one; the number of files that went.

    A record of what replaces what is written before any file moves, so a crash in between is finished by the next call.
    Until then, and for a moment in any case, readers may see rows twice; one that has listed the old files may miss them.
    """
    _finish_compaction(spark, path)
    old = paths.files(spark, path)
    if len(old) <= more_than:
        return 0
    stage = f"_compact-{uuid.uuid4().hex}"
    rows = spark.read.schema(schema).parquet(*[f"{path}/{name}" for name in old])
    overwrite(rows.coalesce(1), f"{path}/{stage}")
    paths.replace_text(spark, f"{path}/{COMPACTED_FILE}", json.dumps({"stage": stage, "old": old}))
    _finish_compaction(spark, path)
    return len(old)


def _finish_compaction(spark: SparkSession, path: str) -> None:
    text = paths.read_text(spark, f"{path}/{COMPACTED_FILE}")
    if text is None:
        return
    record = json.loads(text)
    for name in paths.files(spark, f"{path}/{record['stage']}"):
        paths.move(spark, f"{path}/{record['stage']}/{name}", f"{path}/{name}")
    with ThreadPoolExecutor(RENAMES) as pool:
        list(pool.map(lambda name: paths.delete(spark, f"{path}/{name}"), record["old"]))
    paths.delete(spark, f"{path}/{record['stage']}")
    paths.delete(spark, f"{path}/{COMPACTED_FILE}")


# --- snapshots -------------------------------------------------------------------------------------------------------


def current_snapshot(spark: SparkSession, path: str) -> str | None:
    """Folder of the current version, or None if the table was never written."""
    name = paths.read_text(spark, f"{path}/{POINTER}")
    return f"{path}/{name.strip()}" if name else None


def snapshot_exists(spark: SparkSession, path: str) -> bool:
    return current_snapshot(spark, path) is not None


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    current = current_snapshot(spark, path)
    if current is None:
        raise FileNotFoundError(f"no snapshot under {path}")
    return spark.read.parquet(current)


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write the next version beside the current one and switch to it.

    ``df`` may read the current version.  A crash before the switch leaves readers on the old version.
    """
    folder = f"version={uuid.uuid4().hex}"
    overwrite(df, f"{path}/{folder}", partition_by)
    paths.replace_text(df.sparkSession, f"{path}/{POINTER}", folder)
    return f"{path}/{folder}"


def drop_old_snapshots(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete every version but the current one and the ``keep`` - 1 newest others; run it when no reader can still be on
    one that goes."""
    current = current_snapshot(spark, path)
    if current is None:
        return []
    old = [f"{path}/{name}" for name in paths.subfolders(spark, path) if f"{path}/{name}" != current]
    if keep > 1:
        old = sorted(old, key=lambda folder: paths.modified(spark, folder), reverse=True)[keep - 1 :]
    for folder in old:
        paths.delete(spark, folder)
    return old


def promote(spark: SparkSession, source: str, target: str) -> str:
    """Copy a table's current snapshot to another layer."""
    return write_snapshot(read_snapshot(spark, source), target)


# --- partitioned tables ----------------------------------------------------------------------------------------------


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """Read with the schema kept beside the data.

    Partitions written before a column appeared yield null for it, and neither file footers nor partition values have
    to be sampled to find the schema, however many files there are.
    """
    schema = _stored_schema(spark, path)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def _stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    text = paths.read_text(spark, f"{path}/{SCHEMA_FILE}")
    return T.StructType.fromJson(json.loads(text)) if text else None


def _keep_schema(spark: SparkSession, path: str, df: DataFrame) -> None:
    paths.replace_text(spark, f"{path}/{SCHEMA_FILE}", df.schema.json())


class Rewritten(list):
    """Partition values that an upsert rewrote, and how many rows it brought."""

    def __init__(self, values=(), rows: int = 0) -> None:
        super().__init__(values)
        self.rows = rows


def upsert_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition: str,
    nullable_keys: bool = False,
    stable_partition: bool = False,
    on_duplicate: OnDuplicate | str = OnDuplicate.ERROR,
    order: Sequence[str] = (),
) -> Rewritten:
    """Upsert ``source`` into a partitioned Parquet table, creating it if missing.

    Several source rows of one key are an error, or resolved as ``on_duplicate`` says.  Where the source's keys are stored
    is looked up in an index beside the table (:mod:`keyindex`), which is built once the table is larger than a scan of its
    keys is worth.  A large batch, of ``keyindex.SCAN_SHARE`` of the table's rows or more, would reach every bucket: it drops
    the index, scans the keys, and the next small batch builds the index anew.
    ``stable_partition`` promises that a key never changes partition, which saves the look-up.  A column that is text on one side only
    becomes text; where that, or a wider number, changes a stored column's type, the whole table is rewritten once.

    An upsert that was interrupted is finished first.  The partition values that are returned and otherwise pass through
    the driver are bounded by the number of partitions, not by rows.
    """
    recover(spark, path)
    if not paths.has_data(spark, path):
        source = resolve_duplicates(source, keys, on_duplicate, order)
        overwrite(source, path, [partition])
        _keep_schema(spark, path, source)
        return Rewritten([], read_partitioned(spark, path).count())  # from the files' footers
    checked = OnDuplicate(on_duplicate) is OnDuplicate.ERROR
    if not checked:
        source = resolve_duplicates(source, keys, on_duplicate, order)
    stage = f"{path}/_stage-{uuid.uuid4().hex}"
    try:
        return _rewrite(spark, path, stage, source, list(keys), partition, nullable_keys, stable_partition, checked)
    except Exception:
        if not paths.exists(spark, f"{path}/{STAGED_FILE}"):
            paths.delete(spark, stage)
        raise


def _rewrite(spark, path, stage, source, keys, partition, nullable_keys, stable_partition, checked) -> Rewritten:
    schema = _stored_schema(spark, path) or read_partitioned(spark, path).schema
    text = F.col(partition).cast("string").alias("__text")
    empty = local_frame(spark, [], schema)
    columns, as_text = all_columns([empty, source]), textual_conflicts([empty, source])
    # The batch is computed once, by the job that writes it in its final form; the rest reads what it needs of the files.
    arriving = align(empty, columns, as_text).union(align(source, columns, as_text))
    merged_schema = arriving.schema
    overwrite(arriving, stage, [partition])
    names = [f"{stage}/{name}" for name in paths.subfolders(spark, stage)]
    if not names:
        paths.delete(spark, stage)
        return Rewritten()
    source = spark.read.schema(merged_schema).option("basePath", stage).parquet(*names)
    if checked:
        checked_key_count(source, keys)
    found = source.groupBy(partition, text).agg(F.count("*").alias("rows")).collect()
    rows = sum(r["rows"] for r in found)
    small = rows <= BROADCAST_ROWS
    touched = {r["__text"]: r[partition] for r in found}
    if any(merged_schema[f.name].dataType != f.dataType for f in schema.fields):
        keyindex.drop(spark, path)
        affected = read_partitioned(spark, path)
        touched |= {r["__text"]: r[partition] for r in affected.select(partition, text).distinct().collect()}
    else:
        if stable_partition:
            keyindex.drop(spark, path)
        else:
            # A key may move between partitions, so these are rewritten even if the source brings them nothing.
            index, target = keyindex.KeyIndex(spark, path, tuple(keys), partition, schema), read_partitioned(spark, path)
            indexed = small and index.exists()
            stored = 0 if indexed else target.count()  # opens every file
            if not small and rows >= keyindex.SCAN_SHARE * stored:
                keyindex.drop(spark, path)
                touched |= index.scan(target, source)
            elif indexed or index.exists() or stored > keyindex.INDEX_FROM:
                touched |= index.locate(target, source, small)
            else:
                replaced = semi_join(target.select(*keys, partition), source, keys, nullable_keys, small)
                touched |= {r["__text"]: r[partition] for r in replaced.select(partition, text).distinct().collect()}
        # Only the touched folders are listed and read, however many the table has.
        names = [f"{path}/{name}" for name in _folders(spark, path, partition, list(touched))]
        affected = spark.read.schema(schema).option("basePath", path).parquet(*names) if names else None
    if affected is not None:
        kept = align(anti_join(affected, source, keys, nullable_keys, small), columns, as_text)
        _writer(kept.union(local_frame(spark, [], merged_schema).select(*kept.columns)), "append", [partition]).parquet(stage)
    _replace_partitions(spark, path, stage, merged_schema, partition, list(touched))
    return Rewritten(touched.values(), rows)


def _replace_partitions(
    spark: SparkSession, path: str, stage: str, schema: T.StructType, partition: str, touched: list[str | None]
) -> None:
    """Put the staged rows in place of the touched partitions, so that no crash loses a row.

    All new files are in a stage inside the table; then a record says that it is complete.  Only then are folders
    replaced, by renames that :func:`recover` can take up again.
    """
    filled = set(paths.subfolders(spark, stage))
    gone = [name for name in _folders(spark, path, partition, touched) if name not in filled]
    record = {"stage": stage.rsplit("/", 1)[1], "emptied": gone, "schema": schema.json()}
    paths.replace_text(spark, f"{path}/{STAGED_FILE}", json.dumps(record))
    recover(spark, path)


def _folders(spark: SparkSession, path: str, partition: str, values: list[str | None]) -> list[str]:
    """Folders of the given partition values, looked up by what their escaped names stand for."""
    wanted = {NULL_PARTITION if v is None else v for v in values}
    names = [n for n in paths.subfolders(spark, path) if n.startswith(f"{partition}=")]
    return [n for n in names if unquote(n.split("=", 1)[1]) in wanted]


def recover(spark: SparkSession, path: str) -> bool:
    """Finish an upsert that has staged all its files; every step may be repeated."""
    text = paths.read_text(spark, f"{path}/{STAGED_FILE}")
    if text is None:
        return False
    record = json.loads(text)
    stage = f"{path}/{record['stage']}"

    def put(name: str) -> None:
        paths.delete(spark, f"{path}/{name}")
        paths.move(spark, f"{stage}/{name}", f"{path}/{name}")

    # Requests to the file system, not work: many partitions would otherwise wait for each other's renames.
    with ThreadPoolExecutor(RENAMES) as pool:
        list(pool.map(put, paths.subfolders(spark, stage)))
        list(pool.map(lambda name: paths.delete(spark, f"{path}/{name}"), record["emptied"]))
    paths.replace_text(spark, f"{path}/{SCHEMA_FILE}", record["schema"])
    paths.delete(spark, stage)
    paths.delete(spark, f"{path}/{STAGED_FILE}")
    return True


# --- catalog ---------------------------------------------------------------------------------------------------------


def table_exists(spark: SparkSession, table: str, schema: str = "default") -> bool:
    return spark.catalog.tableExists(f"{schema}.{table}")


def register_table(spark: SparkSession, table: str, path: str, schema: str = "default") -> None:
    """Make a Parquet location known to the catalog, creating the schema if needed.

    The entry is external, so the data stay, and names the columns, partitions and, for a snapshot table, the version that
    are there now: register again after the next write.  An entry that exists is altered, so readers find the table all the
    time; it is made anew only where a column has changed its type or gone, or the partitioning is another.
    """
    current = current_snapshot(spark, path)
    location = current or path
    stored = _stored_schema(spark, path) if current is None else None
    partition = next((n.split("=", 1)[0] for n in paths.subfolders(spark, path) if "=" in n and n[0] != "_"), None) if stored else None
    wanted = stored or spark.read.parquet(location).schema
    name = f"`{schema}`.`{table}`"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    if not (table_exists(spark, table, schema) and _alter(spark, name, wanted, location, partition)):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        columns = f" ({_ddl(wanted.fields)})" if stored else ""
        by = f" PARTITIONED BY (`{partition}`)" if partition else ""
        spark.sql(f"CREATE TABLE {name}{columns} USING parquet{by} LOCATION '{location}'")
    if any(column.isPartition for column in spark.catalog.listColumns(f"{schema}.{table}")):
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(f"{schema}.{table}")


def _ddl(fields: Sequence[T.StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def _alter(spark: SparkSession, name: str, wanted: T.StructType, location: str, partition: str | None) -> bool:
    """Bring an entry up to date in place; False if that is not possible."""
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    columns = {c.name: c for c in spark.catalog.listColumns(name)}
    types = {f.name: f.dataType.simpleString() for f in wanted.fields}
    partitioned = [c for c in columns if columns[c].isPartition]
    same = described.get("Type") == "EXTERNAL" and described.get("Provider", "").lower() == "parquet"
    if not same or any(types.get(c) != columns[c].dataType for c in columns):
        return False
    moved = paths.qualified(spark, described["Location"]) != paths.qualified(spark, location)
    if (partition and partitioned != [partition]) or (partitioned and moved):
        return False
    if new := [f for f in wanted.fields if f.name not in columns]:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_ddl(new)})")
    if moved:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    return True


def replace_managed_table(df: DataFrame, table: str, schema: str = "default") -> None:
    """Create-or-replace a managed table from a query."""
    df.sparkSession.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    df.write.mode("overwrite").format("parquet").saveAsTable(f"{schema}.{table}")
