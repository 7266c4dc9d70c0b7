"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again by the next.

Every stage keeps the columns of documents, but for the last, which adds `copies`, the times that the mix takes a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinfold.llm import decontamination, mixing, quality_rules, simhash, suffix_dedup
from kinfold.llm.shared import stash, table


def _by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.stage(spark, docs, sf_dir)


def _near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.stage(spark, docs, sf_dir)


def _passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.stage(spark, docs, sf_dir)


def _leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.stage(spark, docs, sf_dir)


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.stage(spark, docs, sf_dir)


STAGES = [
    ("quality rules", _by_rules),
    ("SimHash near-dedup", _near_copies),
    ("suffix-array dedup", _passages),
    ("benchmark decontamination", _leaks),
    ("mixing", _mix),
]

#: SQL has neither the connected components of fingerprints nor the removal of repeated bytes; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, from `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stash(step(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
