"""The documents' way through the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.llm import decontaminate, language_id, line_dedup, mixing, near_dedup
from murmur.llm.common import prepared, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Bytes by which the best dictionary must win; ties only are rejected, so clean texts stay.
MIN_MARGIN = 1 / language_id.PARTS


def clear_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a clear language go."""
    prepared(spark)
    return language_id.accepted(docs, language_id.learn(docs), MIN_MARGIN)


def new_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Lines of windows that occurred before go from the texts, and with them the documents
    that they leave blank; n_chars follows."""
    prepared(spark)
    out = line_dedup.dedup(docs).where("n_removed = 0 OR trim(text) <> ''")
    return out.select(*docs.columns).withColumn("n_chars", F.length("text").cast("long"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of near duplicates the document with the smallest id stays."""
    prepared(spark)
    return near_dedup.one_of_each(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    windows = decontaminate.window_set(table(spark, folder, "benchmark"))
    return decontaminate.clean(docs, windows)


def in_target_mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents get the rate and copies of the target mix; those with no copy go."""
    labels = mixing.domains_of(table(spark, folder, "labels"))
    return mixing.mixed_rows(docs, labels, mixing.TARGETS)


STAGES: list[tuple[str, Stage]] = [
    ("language", clear_language),
    ("lines", new_lines),
    ("near_duplicates", one_of_each_group),
    ("decontaminate", without_benchmarks),
    ("mixing", in_target_mix),
]

#: Compression and model fits are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
