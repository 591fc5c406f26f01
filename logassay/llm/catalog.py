"""Registered queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logassay.llm import decontamination, hard_negatives, importance_resampling, line_dedup
from logassay.llm.embedding_dedup import near_vectors
from logassay.llm.interpolated_lm import lm_scores
from logassay.llm.license_scan import license_scan
from logassay.llm.ngram_join import similar_documents
from logassay.llm.personal_data import personal_data
from logassay.llm.quality import quality_scores
from logassay.llm.sentence_pieces import round_trips
from logassay.llm.substring_dedup import digested, without_repeats
from logassay.llm.token_counts import token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id"
    )


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(without_repeats(table(spark, sf_dir, "documents")))


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.cut_repeated_lines(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_lines", "n_removed",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


SQL["op2_line_dedup"] = line_dedup.SQL


@query
def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("n_matches")


@query
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op8_benchmark_decontamination"] = decontamination.SQL


@query
def op9_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trips(table(spark, sf_dir, "documents"))


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


SQL["op13_hard_negatives"] = hard_negatives.SQL


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resampled(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


SQL["op12_importance_resampling"] = importance_resampling.SQL


@query
def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
