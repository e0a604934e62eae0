"""The corpus pipeline: documents through filters and near-duplicate removal into sequences.

Every stage works on all rows its predecessor kept. All but the last return the columns of
documents as they came; n_chars follows a text that a stage changes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoalmark.llm import language, line_dedup, near_dup, packing, quality, queries
from shoalmark.session import configure, ship_package, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Documents no language has this share of the words of are rejected.
LEAST_LANGUAGE_SHARE = 0.4


def with_text(docs: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """``docs`` with another column as text, and n_chars to match where there is one."""
    docs = docs.withColumn("text", F.col(text))
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those without a main language.

    The model learns from the documents themselves, outside its held-out fold. Where none of
    them is labelled there is no model, and every document with a letter stays.
    """
    labeller = language.train(docs)
    if labeller is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    judged = language.mark(docs, labeller)
    return judged.where((F.col("lang_pred") != language.UNDETERMINED)
                        & (F.col("lang_share") >= LEAST_LANGUAGE_SHARE)).select(docs.columns)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that fail the rules; the others lose the lines that failed."""
    return with_text(quality.assess(docs).where("kept"), "clean_text", docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted. A document of which nothing is left,
    because all of it is a copy, is gone."""
    left = line_dedup.dedup_lines(docs).where((F.col("n_removed") == 0) | F.col("text").rlike(line_dedup.WORD))
    return with_text(left, "text", docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id."""
    return near_dup.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a kept document, with its place in a sequence."""
    return packing.pack(docs, queries.BYTE_BPE)


def on_workers(function: Stage) -> Stage:
    """A stage whose workers have the package."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(configure(spark))
        return function(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("language_id", on_workers(identify_language)),
    ("quality_rules", on_workers(apply_quality_rules)),
    ("line_dedup", on_workers(remove_repeated_lines)),
    ("near_dedup", on_workers(remove_near_duplicates)),
    ("best_fit_packing", on_workers(pack)),
]

# Language prediction and packing cannot be written in SQL; tests hold each stage against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
