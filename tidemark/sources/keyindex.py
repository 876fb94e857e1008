"""Where the keys of a partitioned table are, kept beside it, so that an upsert need not scan the table to find them.

The index holds pairs (hash of the key, partition value), dealt into buckets by the hash; a batch reads the buckets of its
own keys.  It may hold too many pairs, never too few: pairs are added before the data change, a key that moves away leaves
its old pair behind, and two keys may share a hash.  What is too much costs the rewrite of a partition that did not need it,
and no row.  Writers that do not keep the index drop it, and the next upsert builds it from the table's key columns.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import anti_join, semi_join
from tidemark.sources import paths

STATE = "_keys/_STATE"
#: Pairs a bucket is made for, 12 bytes each or so; the number of buckets follows when the index is built or compacted.
BUCKET_PAIRS, MAX_BUCKETS = 2_000_000, 1 << 14
#: Rows from which a table gets an index; the keys of a smaller one are scanned sooner than an index is kept.
INDEX_FROM = 1_000_000
#: Share of the table's rows from which a batch too large to broadcast scans the keys: looking so many up costs more.
SCAN_SHARE = 0.1
#: Appends after which pairs are written anew in few files.
MAX_APPENDS = 32

_HASH, _PART, _BUCKET = "key_hash", "part", "bucket"


def drop(spark: SparkSession, path: str) -> None:
    """Forget the index of a table that is changed without keeping it."""
    paths.delete(spark, f"{path}/{STATE}")


@dataclass(frozen=True)
class KeyIndex:
    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    partition: str
    schema: T.StructType  # of the table

    def _state(self) -> dict | None:
        text = paths.read_text(self.spark, f"{self.path}/{STATE}")
        state = json.loads(text) if text else None
        current = [[k, self.schema[k].dataType.json()] for k in (*self.keys, self.partition)]
        return state if state and state["columns"] == current else None

    def exists(self) -> bool:
        return self._state() is not None

    def _keep(self, folder: str, buckets: int, pairs: int, appends: int) -> dict:
        columns = [[k, self.schema[k].dataType.json()] for k in (*self.keys, self.partition)]
        state = {"folder": folder, "buckets": buckets, "pairs": pairs, "appends": appends, "columns": columns}
        paths.replace_text(self.spark, f"{self.path}/{STATE}", json.dumps(state))
        return state

    def pairs_of(self, df: DataFrame) -> DataFrame:
        """Distinct pairs of table or batch rows."""
        return self._hashed(df).distinct()

    def _hashed(self, df: DataFrame) -> DataFrame:
        """Pairs of table or batch rows; null keys match nothing and have none.

        Keys are hashed in the table's types, so that a batch with narrower numbers hashes alike.
        """

        def typed(key: str) -> Column:
            dtype = self.schema[key].dataType
            value = F.col(f"`{key}`").cast(dtype)
            # Zeros of either sign are one key.
            return value + F.lit(0).cast(dtype) if isinstance(dtype, (T.FloatType, T.DoubleType)) else value

        rows = df.na.drop(subset=list(self.keys))
        part = F.col(f"`{self.partition}`").cast(self.schema[self.partition].dataType)
        return rows.select(F.xxhash64(*[typed(k) for k in self.keys]).alias(_HASH), part.alias(_PART))

    def _write(self, pairs: DataFrame, folder: str, buckets: int, mode: str) -> None:
        dealt = pairs.withColumn(_BUCKET, F.pmod(_HASH, F.lit(buckets)))
        dealt.hint("rebalance", F.col(_BUCKET)).write.mode(mode).partitionBy(_BUCKET).parquet(f"{self.path}/_keys/{folder}")

    def _renew(self, pairs: DataFrame, n: int) -> dict:
        buckets = min(MAX_BUCKETS, 1 << max(0, ceil(log2(max(1, n / BUCKET_PAIRS)))))
        folder = f"pairs-{uuid.uuid4().hex}"
        self._write(pairs, folder, buckets, "overwrite")
        old = paths.subfolders(self.spark, f"{self.path}/_keys")
        state = self._keep(folder, buckets, n, 0)
        for name in old:
            if name != folder:
                paths.delete(self.spark, f"{self.path}/_keys/{name}")
        return state

    def _read(self, state: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        """Pairs of the given buckets, or all; only their folders are listed and read."""
        folder = f"{self.path}/_keys/{state['folder']}"
        names = paths.subfolders(self.spark, folder)
        wanted = None if buckets is None else {f"{_BUCKET}={b}" for b in buckets}
        found = [f"{folder}/{name}" for name in names if name.startswith(f"{_BUCKET}=") and (wanted is None or name in wanted)]
        schema = T.StructType([T.StructField(_HASH, T.LongType()), T.StructField(_PART, self.schema[self.partition].dataType)])
        if not found:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*found)

    def matching(self, batch_pairs: DataFrame, small: bool = False) -> DataFrame:
        """Stored pairs of the batch's keys.  ``small``: the batch was counted and its hashes may be broadcast."""
        state = self._state()
        rows = batch_pairs.select(F.pmod(_HASH, F.lit(state["buckets"])).alias(_BUCKET)).distinct()
        buckets = [r[0] for r in rows.collect()]  # bounded by MAX_BUCKETS
        return semi_join(self._read(state, buckets), batch_pairs, [_HASH], False, small)

    def scan(self, table: DataFrame, batch: DataFrame) -> dict[str | None, object]:
        """Partition values, by their text, that may hold keys of ``batch``, without an index: hashes of all keys are joined."""
        hits = self._hashed(table).join(self._hashed(batch).select(_HASH), _HASH, "left_semi").select(_PART).distinct()
        return {r["text"]: r[_PART] for r in hits.select(_PART, F.col(_PART).cast("string").alias("text")).collect()}

    def locate(self, table: DataFrame, batch: DataFrame, small: bool = False) -> dict[str | None, object]:
        """Partition values, by their text, that may hold keys of ``batch``; its own pairs are then part of the index.

        ``table`` is read, its key columns alone, only if there is no index yet.
        """
        if self._state() is None:
            pairs = self.pairs_of(table)
            self._renew(pairs, table.count())  # a count of rows comes from the files' footers
        arriving = self.pairs_of(batch).persist()
        stored = self.matching(arriving, small).persist()
        try:
            text = F.col(_PART).cast("string").alias("text")
            found = {r["text"]: r[_PART] for r in stored.select(_PART, text).distinct().collect()}
            self._add(arriving, stored, small)
        finally:
            stored.unpersist()
            arriving.unpersist()
        return found

    def _add(self, arriving: DataFrame, stored: DataFrame, small: bool) -> None:
        state = self._state()
        # A null partition value is equal to none in a join: such pairs are added again and fall together when compacted.
        new = anti_join(arriving, stored, [_HASH, _PART], True, small).persist()
        try:
            n = new.count()
            if not n:
                return
            self._write(new, state["folder"], state["buckets"], "append")
        finally:
            new.unpersist()
        state = self._keep(state["folder"], state["buckets"], state["pairs"] + n, state["appends"] + 1)
        if state["appends"] >= MAX_APPENDS:
            self._renew(self._read(state).distinct(), state["pairs"])
