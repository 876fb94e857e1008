"""A corpus pipeline of five stages, each one of the operators of ``tidemark.llm``.

Each stage works on all rows that the one before it kept, and all but the last return the columns of ``documents``.  The
stages hold near-duplicates by string distance, a flow and a tokenizer, which SQL cannot express: ``ORACLE_SQL`` is None,
and ``tests/llm/test_pipeline.py`` compares the rows with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard_join, mixing, quality_rules, records
from tidemark.llm.common import stored
from tidemark.llm.queries import END_ID, tokenizer_path

ORACLE_SQL = None


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that link, that with the smallest id stays."""
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the mix takes something stay; one that it takes several times is repeated."""
    mixed = mixing.mix(docs, F.array("source"))
    copies = F.when(F.col("`mix!`.size") > 0, F.col("`mix!`.taken") / F.col("`mix!`.size")).otherwise(0).cast("int")
    repeated = mixed.filter(copies > 0).withColumn("copy!", F.explode(F.sequence(F.lit(1), copies)))
    return repeated.drop("mix!", "copy!")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token-id records and return what they say when read back."""
    return records.digests(records.write(docs, records.folder(spark), tokenizer_path("word_bpe_49k.json"), END_ID))


STAGES = [
    ("quality rules", rules),
    ("Jaccard join", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("token records", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
