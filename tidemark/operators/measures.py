"""Checks that ride on a load: rows, nulls per column and broken rules come out of the job that reads or writes the rows.

A rule is a name and a boolean SQL expression that every row has to satisfy; null counts as broken.  What a load measured
is kept in a small table, so layers are compared from what their loads wrote down, without reading either layer again.

Where a task runs again, after an executor was lost, Spark may count its rows twice in an observation.  A measure that
disagrees is therefore a reason to look, never one to drop rows; which rows are kept apart is decided row by row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.runlog import WriteMetrics
from tidemark.sources import paths
from tidemark.sources.rows import local_frame
from tidemark.spec import as_utc

#: Column that names the rules a row breaks.
BROKEN = "__broken_rules"

ROWS, REJECTED, NULLS, BREAKS = "rows", "rejected", "nulls", "broken"

MEASURES_DDL = "recorded_utc timestamp, layer string, source string, batches array<string>, measure string, name string, value long"


def holds(expression: str) -> Column:
    return F.coalesce(F.expr(expression).cast("boolean"), F.lit(False))


def broken_rules(rules: Mapping[str, str]) -> Column:
    """Names of the rules that a row breaks, in the order of ``rules``; an empty array where it breaks none."""
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(~holds(text), F.lit(name)) for name, text in rules.items()]))


def with_broken_rules(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    return df.withColumn(BROKEN, broken_rules(rules))


def sound(df: DataFrame) -> DataFrame:
    """Rows of :func:`with_broken_rules` that break no rule."""
    return df.where(F.size(BROKEN) == 0).drop(BROKEN)


def unsound(df: DataFrame) -> DataFrame:
    """The other rows, with the names of the rules they break."""
    return df.where(F.size(BROKEN) > 0)


class LoadMetrics(WriteMetrics):
    """Rows and largest watermark of a load and, of the same job, nulls per column and rows per broken rule.

    Give it the frame of :func:`with_broken_rules` if there are rules.
    """

    def __init__(self, watermark: str | None = None, columns: Sequence[str] = (), rules: Mapping[str, str] | None = None) -> None:
        super().__init__(watermark)
        self._columns, self._rules = list(columns), dict(rules or {})

    def aggregates(self) -> list[Column]:
        nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null{i}") for i, c in enumerate(self._columns)]
        broken = [F.count_if(F.array_contains(BROKEN, r)).alias(f"broken{i}") for i, r in enumerate(self._rules)]
        return super().aggregates() + nulls + broken + [F.count_if(F.size(BROKEN) > 0).alias("rejected")] * bool(broken)

    @property
    def nulls(self) -> dict[str, int]:
        return {c: self.value(f"null{i}", 0) for i, c in enumerate(self._columns)}

    @property
    def broken(self) -> dict[str, int]:
        return {r: self.value(f"broken{i}", 0) for i, r in enumerate(self._rules)}

    @property
    def rejected(self) -> int:
        return self.value("rejected", 0)

    def measures(self, layer: str, source: str, batches: Sequence[str], moment: datetime) -> list[tuple]:
        """Rows for the table of measures.  Column names are compared without regard to case, as Spark resolves them."""
        found = [(ROWS, None, self.rows), (REJECTED, None, self.rejected)]
        found += [(NULLS, c.lower(), n) for c, n in self.nulls.items()]
        found += [(BREAKS, rule, n) for rule, n in self.broken.items()]
        return [(as_utc(moment), layer, source, list(batches), *entry) for entry in found]


def measures_frame(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return local_frame(spark, list(rows), MEASURES_DDL)


def read_measures(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MEASURES_DDL).parquet(path) if paths.exists(spark, path) else measures_frame(spark, [])


def parity(measures: DataFrame, before: str, after: str) -> DataFrame:
    """What the loads of layer ``after`` read, beside what was written down for their batches in layer ``before``.

    One row per load and measure: the row count, and the nulls of every column that either side has.  A batch that was
    landed without a column counts all its rows as nulls of it, which is how it is read beside batches that have it.  Of a
    load or batch that was repeated the newest measures count; a batch that was not measured makes ``expected`` null.
    """
    compared = measures.where(F.col("measure").isin(ROWS, NULLS)).withColumn("name", F.coalesce("name", F.lit("")))
    newest = F.max_by("value", "recorded_utc").alias("value")
    loads = compared.where(F.col("layer") == after).groupBy("source", "batches", "measure", "name").agg(newest)
    wrote = (
        compared.where(F.col("layer") == before)
        .groupBy("source", F.col("batches")[0].alias("batch"), "measure", "name").agg(newest)
    )
    members = loads.select("source", "batches").distinct().withColumn("batch", F.explode("batches"))
    sizes = wrote.where(F.col("measure") == ROWS).select("source", "batch", F.col("value").alias("size"))
    on_batch = members.join(wrote, ["source", "batch"])
    names = (
        loads.select("source", "batches", "measure", "name")
        .union(on_batch.select("source", "batches", "measure", "name")).distinct()
    )
    per_batch = (
        names.join(members, ["source", "batches"])
        .join(sizes, ["source", "batch"], "left")
        .join(wrote, ["source", "batch", "measure", "name"], "left")
        .withColumn("value", F.coalesce("value", F.when(F.col("measure") == NULLS, F.col("size"))))
    )
    known = F.count("value") == F.count("*")
    expected = per_batch.groupBy("source", "batches", "measure", "name").agg(F.when(known, F.sum("value")).alias("expected"))
    found = loads.withColumnRenamed("value", "found")
    sides = expected.join(found, ["source", "batches", "measure", "name"], "left")
    return sides.withColumn("ok", F.coalesce(F.col("expected") == F.col("found"), F.lit(False)))
