"""The corpus pipeline: documents through five operators, each stage written and read again.

1. ``quality``: documents that the line rules reject go.
2. ``near_duplicates``: one document of each group of near-duplicates stays.
3. ``decontamination``: documents that hold a benchmark item go.
4. ``secrets``: secrets are replaced in the texts; no document goes.
5. ``tokens``: token ids of each document, and the digest of what they decode to.

The first four return the columns of ``documents``. Each stage sees all rows
that the one before it kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pitlane.llm import bpe, decontaminate, line_quality, neardup, secret_scan
from pitlane.llm.common import table
from pitlane.sources import shared

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.without_secrets(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encoded(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: Character models and merges have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared.store(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
