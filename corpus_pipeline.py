"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as
Parquet and read again as the next stage's documents. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import jaccard, line_runs, mixing, packing, quality
from tidemark.llm.common import stage
from tidemark.llm.queries import tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail a rule go, and documents that the rules reject."""
    return quality.clean_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay in one document."""
    return line_runs.drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id."""
    return jaccard.one_of_each_class(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, as their source's target asks."""
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all token pieces in sequences of 1024."""
    return packing.pack(docs, tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("source mix", source_mix),
    ("best-fit packing", best_fit_packing),
]

#: Tokens are not expressible in SQL; tests compare run() with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; without documents there are no rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
