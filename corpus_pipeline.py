"""A pipeline over documents: toxicity, language, near duplicates, benchmark items, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept.  All but the last return rows of
documents, with all their columns; the last returns the packed pieces.  Nulls, empty and very long texts, ties, repeated
rows, empty tables and extra columns of any name have the results that each operator's docstring defines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from namewright.llm import decontaminate, jaccard_tree, language_mix, packing, tokens, toxicity
from namewright.llm.common import materialize, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted to be toxic; null and empty texts score as a window without words."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which one language holds two fifths at least; null and empty texts, and those without a letter, go."""
    return language_mix.with_language(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of smallest id, of each group that links by shingles of five words and a similarity of 0.8; of rows of one id one."""
    return jaccard_tree.one_of_each(docs, size=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold four fifths of a benchmark item's shingles; rows without an id are known by their text."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of all documents with their bins; a text without tokens is one piece, its end token."""
    return packing.pack(docs, tokens.vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]
#: Two of the stages are learned models, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
