"""Cleaning a corpus: toxicity, quality rules, near-duplicates, personal data, packing. Each stage works on what the one before it kept."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from starloom.llm import near_dedup, packing, pii, quality_rules, toxicity  # noqa: E402
from starloom.llm.common import read  # noqa: E402
from starloom.session import materialise  # noqa: E402


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, read(spark, sf_dir, "labels"))


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(docs)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.vocabulary())


STAGES = [
    ("toxicity", reject_toxic),
    ("quality rules", reject_low_quality),
    ("near duplicates", keep_one_of_near_duplicates),
    ("personal data", redact_personal_data),
    ("packing", pack),
]

#: Compression lengths, boosted trees and tokenizers can't be written in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
