"""From raw documents to packed training windows, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the
next stage's documents.  All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from missivelake.llm import decontaminate, exact_dedup, langid, near_copies, packing
from missivelake.llm.common import table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    return langid.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, of similarity 0.8 or more on five-word shingles."""
    return near_copies.keep_one(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the training windows."""
    placed = packing.pack(docs)
    return placed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("language", language), ("exact", exact), ("near", near), ("benchmark_free", benchmark_free), ("windows", windows)]

#: The language, near-duplicate, alignment and packing stages are not expressible in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; every result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
