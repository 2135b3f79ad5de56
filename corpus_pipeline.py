"""From raw documents to packed training sequences: five stages, each on all that the one before kept."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rtdw.llm import decision_list, disclosure, packing, simhash, toxicity  # noqa: E402
from rtdw.llm.common import stored  # noqa: E402
from rtdw.llm.queries import table, vocabulary  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decision_list.quality_filter(docs, table(spark, sf_dir, "labels"))


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_filter(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.simhash_filter(docs, shingle=3, distance=2)


def protect(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return disclosure.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary(spark))


STAGES = [
    ("quality_rules", quality),
    ("toxicity", clean_language),
    ("simhash", deduplicate),
    ("pii", protect),
    ("packing", pack),
]

#: The learned and iterative stages are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
