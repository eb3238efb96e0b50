"""One query for each operator of this package, over whole tables, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pitlane.llm import (
    ball_tree, bpe, decontaminate, license_scan, line_quality, neardup, secret_scan, sharding, simhash_grid, text_quality,
    token_alignment, token_counts, toxicity,
)
from pitlane.llm.common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(table(spark, sf_dir, "documents"))


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_quality(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.toxicity(documents, toxicity.trained(documents, table(spark, sf_dir, "labels")))


def op4_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"), shards=8)


def op5_text_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return text_quality.quality(documents, text_quality.trained(documents, table(spark, sf_dir, "labels")))


def op6_secret_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_simhash_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_grid.near_duplicates(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op13_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_line_quality, op3_toxicity, op4_slot_sharding, op5_text_quality, op6_secret_markov, op7_token_counts,
        op8_decontamination, op9_near_duplicates, op10_bpe, op11_simhash_grid, op12_token_alignment, op13_ball_tree,
    )
}

SQL: dict[str, str] = {"op2_line_quality": line_quality.SQL, "op9_near_duplicates": neardup.SQL, "op13_ball_tree": ball_tree.SQL}
