"""The corpus pipeline: five stages over the documents table, each written as Parquet and read again for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm.common import stored, table
from tidelog.llm.mixing import mixed_documents
from tidelog.llm.near import without_near_copies
from tidelog.llm.packing import packed
from tidelog.llm.rules import clean_documents
from tidelog.llm.templates import without_recurring_lines


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, with the lines that passed."""
    return clean_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines whose templates recur."""
    return without_recurring_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id: SimHash components, held to a 5-word Jaccard of
    0.8 or more, and what else reaches that."""
    return without_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix; one that is taken twice is two rows."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their sequences."""
    return packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

# The packing needs a tokenizer, which SQL lacks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
