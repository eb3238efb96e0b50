"""Compressed lengths under raw dictionaries, and the calibration of what they say."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Level whose search is thorough, but whose parse still takes any match that saves a byte.
LEVEL = 9
#: Longest text drawn for training, in characters. Scoring reads whole texts.
TRAINING_CHARS = 100_000
#: Characters of all texts learned from together, half for each label: they meet on the driver.
TRAINING_TOTAL = 64_000_000


def lengths(dictionary: bytes, window: int, level: int = LEVEL) -> Callable[[bytes], int]:
    """A function from bytes to their compressed length, headers left out, under a raw dictionary."""
    params = zstandard.ZstdCompressionParameters.from_level(
        level, source_size=window, dict_size=len(dictionary), write_content_size=False, write_dict_id=False,
        write_checksum=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    if dictionary:
        known = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(compression_params=params)
        compress = zstandard.ZstdCompressor(dict_data=known, compression_params=params).compress
    else:
        compress = zstandard.ZstdCompressor(compression_params=params).compress
    return lambda data: len(compress(data))


@dataclass
class Logistic:
    """A logistic model of a few features; ``weights`` ends with the constant."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def __call__(self, features: np.ndarray) -> float:
        z = float(((features - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1])
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(features: np.ndarray, labels: np.ndarray, share: float, penalty: float = 0.1, steps: int = 30) -> Logistic:
    """Newton's method; the rows are weighted so that label 1 has the given share."""
    mean, scale = features.mean(0), features.std(0) + 1e-9
    z = np.column_stack([(features - mean) / scale, np.ones(len(features))])
    found = max(labels.mean(), 1e-9)
    row = np.where(labels > 0, share / found, (1 - share) / max(1 - found, 1e-9))
    ridge = penalty * np.r_[np.ones(z.shape[1] - 1), 1e-6]
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (row * (p - labels)) + ridge * w
        w = w - np.linalg.solve((z * (row * p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(ridge), gradient)
    return Logistic(mean, scale, w)


def learning_rows(labels: DataFrame, name: str) -> DataFrame:
    """Labelled ids that may be learned from: a fifth is held out by the checksum of the id."""
    return labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(name).alias("label")).filter(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    )


def training_texts(
    documents: DataFrame, labels: DataFrame, name: str, rows: tuple[int, int]
) -> tuple[tuple[list[str], list[str]], float]:
    """At most ``rows`` texts of label 0 and 1, and label 1's share of all labels that may be learned from.

    Ids are picked among the labelled documents there are, in the order of a
    hash, so they are the same in every run, until their texts hold
    ``TRAINING_TOTAL`` characters. Of several texts with one id the one of least
    hash counts. The picked ids, at most ``sum(rows)``, are broadcast to the documents.
    """
    known = learning_rows(labels, name).groupBy("doc_id").agg(F.max("label").alias("label"))
    share = known.agg(F.avg("label")).first()[0]
    named = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter(
        F.length("text") <= TRAINING_CHARS
    ).withColumn("text_key", F.xxhash64("text"))
    there = known.join(
        named.groupBy("doc_id").agg(F.min(F.struct("text_key", F.length("text").alias("n"))).alias("one")), "doc_id"
    ).select("doc_id", "label", "one.text_key", "one.n")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [there.filter(F.col("label") == label).orderBy(*order).limit(rows[label]) for label in (0, 1)]
    # A running sum over the picked rows, whose number is bounded.
    so_far = F.sum("n").over(Window.partitionBy("label").orderBy(*order))
    picked = picked[0].unionAll(picked[1]).withColumn("so_far", so_far).filter(F.col("so_far") <= TRAINING_TOTAL // 2)
    texts = (
        named.join(F.broadcast(picked.select("doc_id", "text_key", "label")), ["doc_id", "text_key"])
        .dropDuplicates(["doc_id"])
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .select("label", "text")
        .collect()
    )
    return tuple([t.text for t in texts if t.label == label] for label in (0, 1)), share or 0.0


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


LETTERS = re.compile(r"[^\W\d_]+")
