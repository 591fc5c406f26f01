"""The corpus pipeline: from raw documents to token ids of clean, distinct texts.

Every stage gets the rows its predecessor kept and returns a DataFrame; all but
the last return the columns of ``documents``. Results are written as Parquet
between stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logassay.llm import decontamination, line_dedup, ngram_join, quality, sentence_pieces
from logassay.llm.common import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier rejects go."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows are cut; texts with nothing left go."""
    return line_dedup.cut_stage(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of similar documents the one with the smallest id stays."""
    return ngram_join.keep_one_of_each(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontamination.clean_documents(docs, _table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, instead of the text."""
    coded = sentence_pieces.encode(docs)
    return coded.withColumn("n_tokens", F.size("ids").cast("long")).drop("text")


STAGES = [
    ("quality_classifier", good_documents),
    ("line_dedup", without_repeated_lines),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", without_benchmarks),
    ("sentencepiece_codec", token_ids),
]

# The classifier, the components and the encoding cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
