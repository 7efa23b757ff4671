"""The registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.alignment import alignment_report
from tidelog.llm.ann import nearest_neighbours
from tidelog.llm.classifier import quality_scores
from tidelog.llm.common import table
from tidelog.llm.merkle import merkle_report
from tidelog.llm.mixing import mix_report
from tidelog.llm.packing import packed
from tidelog.llm.rules import quality_report
from tidelog.llm.simhash import near_duplicate_report
from tidelog.llm.substring import substring_report
from tidelog.llm.suffix import suffix_report
from tidelog.llm.templates import line_dedup_report
from tidelog.llm.urls import url_report
from tidelog.llm.warc import archive_report


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_report(spark, table(spark, sf_dir, "pages"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_report(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_report(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup_report(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_report(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_report(table(spark, sf_dir, "documents"))


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_report(table(spark, sf_dir, "pages"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_report(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}
