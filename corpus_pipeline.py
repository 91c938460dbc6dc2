"""A training corpus from raw documents: each stage is one operator, written as Parquet before the next reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spendlake.llm import decontamination, line_dedup, near_dup, packing, quality_rules
from spendlake.sources.scratch import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand earlier in the corpus, in the same or nearly the same words."""
    return line_dedup.cleaned(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dup.keep_one(docs, shingle=3, radius=2)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark."""
    return decontamination.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and the bins they are packed into."""
    return packing.pack_texts(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", good_quality),
    ("line dedup", without_repeated_lines),
    ("simhash near-dedup", without_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", packed),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
