"""The corpus pipeline: documents through five stages, each written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cindermill.llm import decontamination, jaccard_join, line_dedup, packing, quality
from cindermill.llm.common import discard, shared_dir, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base check or the posterior rejects go."""
    return quality.good_documents(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of lines with 50 words or more go from the texts; documents left without text go."""
    return line_dedup.without_copied_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar documents stays."""
    return jaccard_join.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their sequences."""
    return packing.pack(docs)


STAGES = [(f.__name__, f) for f in (quality_rules, line_deduplication, near_duplicates, benchmark_decontamination, best_fit_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result is written as Parquet and reread as the next stage's input, then its folder goes."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline/{uuid.uuid4().hex}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        discard(docs)
        docs = spark.read.parquet(path)
        docs._staged_path = path
    return docs


#: Packing needs the tokenizer, which SQL does not have; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None
