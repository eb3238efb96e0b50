"""Quality by compression: dictionaries of good and of bad labelled text, their difference as a score.

A text is cut into blocks. For each block the compressed lengths under the good
and under the bad dictionary are taken; their difference, divided by the
block's bytes, is the block's verdict, and the length without a dictionary,
divided by the same, its density (repetition needs no dictionary). The whole text is
told by the means and extremes of both, which a logistic model calibrates to
the probability of good quality, on documents the dictionaries have not seen.

At most ``SAMPLES`` documents of each label come to the driver; documents are
scored where they lie, a block at a time.

Nulls: a null text scores like an empty one, 0 like any text of white space; a null ``doc_id`` is kept and not
held out. Repeated rows score alike. Other columns are not read. Without bad
examples every score is 1, without good ones 0. An empty table gives an empty
result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm import common
from pitlane.llm.zstd_models import Logistic, fit, held_out, lengths, training_texts

#: Documents learned from, of label 0 (bad) and of label 1; a third of them calibrates.
SAMPLES = 2_400, 2_400
#: Characters of a block, and of the piece of a training text that goes into a dictionary of so many bytes.
BLOCK, PIECE, DICTIONARY = 512, 96, 49_152
#: Lowest score that predicts good quality.
THRESHOLD = 0.3


def blocks(text: str) -> list[bytes]:
    """The whole text in blocks; the last one may be short."""
    return [text[i : i + BLOCK].encode() for i in range(0, len(text), BLOCK)]


@dataclass
class Quality:
    """Two dictionaries and the calibration; or, without one of the labels, a constant."""

    bad: bytes = b""
    good: bytes = b""
    calibrated: Logistic | None = None
    constant: float = 1.0
    _pair: object = field(default=None, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_pair": None}

    def features(self, text: str) -> np.ndarray:
        if self._pair is None:
            self._pair = lengths(self.bad, BLOCK), lengths(self.good, BLOCK), lengths(b"", BLOCK)
        bad, good, plain = self._pair
        measured = np.array([(len(b), bad(b), good(b), plain(b)) for b in blocks(text)] or [(1, 1, 1, 1)], float)
        size = measured[:, 0]
        verdict = (measured[:, 1] - measured[:, 2]) / size
        density = measured[:, 3] / size
        whole = size.sum()
        return np.array([
            (verdict * size).sum() / whole, verdict.min(), verdict.max(), (verdict < 0).mean(),
            (density * size).sum() / whole, density.min(), density.max(),
            min(np.log(whole), 6), np.log(whole),
        ])

    def score(self, text: str) -> float:
        if self.calibrated is None:
            return self.constant
        return self.calibrated(self.features(text)) if text.strip() else 0.0


def dictionary(texts: list[str]) -> bytes:
    """One piece of each text, from a place that moves on from text to text, until the dictionary is full."""
    pieces, size = [], 0
    rounds = 0
    while texts and size < DICTIONARY and rounds < 64:
        for i, text in enumerate(texts):
            start = (i * 37 + rounds * 61) % 97 * max(len(text) - PIECE, 0) // 97
            piece = text[start : start + PIECE].encode()
            pieces.append(piece)
            size += len(piece)
            if size >= DICTIONARY:
                break
        rounds += 1
    return b"\n".join(pieces)


def train(bad: list[str], good: list[str], share: float) -> Quality:
    """Dictionaries from two thirds of the texts, the calibration from the others."""
    if len(bad) < 3 or len(good) < 3:
        return Quality(constant=1.0 if len(bad) < 3 else 0.0)
    learned, kept = zip(*(([t for i, t in enumerate(side) if i % 3], side[::3]) for side in (bad, good)))
    model = Quality(*map(dictionary, learned))
    features = np.array([model.features(t) for side in kept for t in side])
    marks = np.repeat([0.0, 1.0], [len(side) for side in kept])
    model.calibrated = fit(features, marks, share)
    return model


def trained(documents: DataFrame, labels: DataFrame) -> Quality:
    (bad, good), share = training_texts(documents, labels, "quality", SAMPLES)
    return train(bad, good, share)


def quality(documents: DataFrame, model: Quality) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    shipped = documents.sparkSession.sparkContext.broadcast(model)

    def start() -> common.Work:
        score = shipped.value.score

        def work(batch: pa.RecordBatch) -> dict[str, list | pa.Array]:
            return {"doc_id": batch.column("doc_id"), "score": [score(t) for t in common.texts(batch)]}

        return work

    read = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    scored = common.map_batches(read, "doc_id bigint, score double", start)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
