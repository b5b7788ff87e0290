"""A corpus cleaning job: five stages over ``documents``, each written as Parquet and read as the next one's input.

Every stage takes (spark, docs, sf_dir), works on all rows of docs and
returns the rows that stay, with the columns of documents; the last returns
the packed pieces. Rows with nulls, repeated rows and empty tables are treated
as the stage's operator says.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from costlens.llm.common import bound_batches, stash, table
from costlens.llm.decontaminate import drop_contaminated
from costlens.llm.language import drop_unidentified
from costlens.llm.near_dup import drop_near_duplicates
from costlens.llm.packing import pack
from costlens.llm.quality import drop_low_quality
from costlens.llm.queries import language_model, quality_model


def bounded(stage):
    """The stage with bounded batches to Python."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@bounded
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier rejects."""
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return drop_low_quality(docs, model)


@bounded
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is not identified."""
    return drop_unidentified(docs, language_model(docs))


@bounded
def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return drop_near_duplicates(docs, percent=80)


@bounded
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that share a window of words with a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


@bounded
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into training sequences."""
    return pack(docs)


STAGES = [("quality", quality_stage), ("language", language_stage), ("near_dedup", near_dedup_stage),
          ("decontamination", decontamination_stage), ("packing", packing_stage)]

# Classifiers fitted in numpy are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), name)
    return docs
