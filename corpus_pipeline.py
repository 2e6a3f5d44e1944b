"""A corpus from raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on every row that the stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scrollwork.llm.common import table
from scrollwork.llm.components import stored
from scrollwork.llm.decontamination import remove_contamination
from scrollwork.llm.language import keep_known
from scrollwork.llm.neardup import keep_one_of_each
from scrollwork.llm.packing import pack
from scrollwork.llm.privacy import pseudonymise, session_key


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the profiles know; the rest goes."""
    return keep_known(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of benchmark items."""
    return remove_contamination(docs, table(spark, sf_dir, "benchmark"))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data."""
    return pseudonymise(docs, session_key(spark))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return pack(docs)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("privacy", privacy),
    ("packing", packing),
]

#: Tokenising and fuzzy matching have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each stage's rows written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
