"""Toxicity by compression distance: windows of a text under a toxic and an ordinary dictionary.

A window is one word in lower case between two fixed strings: the first stands
in both dictionaries, so a block is always compressed, the second keeps the
word away from the block's end, where matches are not looked for. How much
shorter a window gets under the toxic dictionary is its distance. Both
dictionaries share the commonest ordinary words; the toxic one ends with words
that hold letter groups much commoner in toxic documents, the ordinary one with
further ordinary words of the same size. Distances are summed up in a few
features with thresholds; a logistic model, fitted on documents that the
dictionaries have not seen, calibrates them to a score.

At most ``SAMPLES`` documents of each label come to the driver; documents are
scored where they lie. Lengths of recurring words are cached in the workers.

Nulls: a null text scores like an empty one, a null ``doc_id`` is kept and not
held out. Repeated rows score alike. Other columns are not read. Without toxic
examples every score is 0, without ordinary ones 1. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm import common
from pitlane.llm.zstd_models import LETTERS, Logistic, fit, held_out, lengths, training_texts

#: Documents learned from, of label 0 and of label 1; a third of them calibrates.
SAMPLES = 4_500, 2_250
#: Bytes of ordinary words in both dictionaries, and of those in which they differ.
SHARED_BYTES, OWN_BYTES = 16_384, 4_096
#: Letters of a group, and the likelihood ratio statistic from which on it tells of toxicity.
GROUP, EVIDENCE = 5, 15.0
CACHE_ENTRIES = 200_000
#: Longest word that is a window; longer ones are cut into pieces of this length.
WORD_CHARS = 64

BEFORE, AFTER = b"~0qZ7@kX^9vJ{2wY}5hQ`8mB|1gT;4rN<6cL>3pF", b"(2=!?_ZQ|xK@&+Vw"
#: Thresholds of distances in bytes and of their share of the ordinary length.
BYTES, SHARES = (2, 3, 4, 6), (0.25, 0.33, 0.4, 0.5)


def windows(text: str) -> set[str]:
    """The different words of a text."""
    words = set(LETTERS.findall(text.lower()))
    long = {w for w in words if len(w) > WORD_CHARS}
    return words - long | {w[i : i + WORD_CHARS] for w in long for i in range(0, len(w), WORD_CHARS)}


@dataclass
class Toxicity:
    """Two dictionaries and the calibration; or, without one of the labels, a constant."""

    ordinary: bytes = b""
    toxic: bytes = b""
    calibrated: Logistic | None = None
    constant: float = 0.0
    _pair: object = field(default=None, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_pair": None}

    def _measure(self):
        if self._pair is None:
            pair = lengths(self.ordinary, 64), lengths(self.toxic, 64)
            empty = [f(BEFORE + AFTER) for f in pair]
            cache: common.Recent[tuple[int, int]] = common.Recent(CACHE_ENTRIES)

            def measure(word: str) -> tuple[int, int]:
                found = cache.get(word)
                if found is None:
                    window = BEFORE + f" {word} ".encode() + AFTER
                    found = pair[0](window) - empty[0], pair[1](window) - empty[1]
                    cache.put(word, found)
                return found

            self._pair = measure
        return self._pair

    def features(self, text: str) -> np.ndarray:
        measured = np.array([*map(self._measure(), windows(text))] or [(0, 0)], float)
        n, distance = len(measured), measured[:, 0] - measured[:, 1]
        share = np.where(measured[:, 0] >= 5, distance / np.maximum(measured[:, 0], 1), 0)
        counts = [(distance >= b).sum() for b in BYTES] + [(share >= s).sum() for s in SHARES]
        return np.array([
            *(c / n**0.5 for c in counts), *(min(c, 4) for c in counts), distance.max(), share.max(), np.log(n),
        ])

    def score(self, text: str) -> float:
        return self.calibrated(self.features(text)) if self.calibrated else self.constant


def _groups(words: set[str]) -> set[str]:
    return {w[i : i + GROUP] for w in (f" {w} " for w in words) for i in range(len(w) - GROUP + 1)}


def _packed(words: list[str], size: int) -> tuple[bytes, int]:
    """As many words as fit, the first one last, where matches cost least; and their number."""
    taken, total = [], 0
    for word in words:
        piece = f"{word} ".encode()
        if total + len(piece) > size:
            break
        taken.append(piece)
        total += len(piece)
    return b"".join(reversed(taken)), len(taken)


def _evidence(toxic: int, ordinary: int, of_toxic: int, of_ordinary: int) -> float:
    """The likelihood ratio statistic of a letter group that is commoner in toxic documents; else 0."""
    if toxic * of_ordinary <= ordinary * of_toxic:
        return 0.0
    share = (toxic + ordinary) / (of_toxic + of_ordinary)
    return 2 * (toxic * np.log(toxic / (of_toxic * share))
                + (ordinary * np.log(ordinary / (of_ordinary * share)) if ordinary else 0.0))


def dictionaries(ordinary: list[str], toxic: list[str]) -> tuple[bytes, bytes]:
    words = [[windows(t) for t in texts] for texts in (ordinary, toxic)]
    groups = [Counter(g for w in side for g in _groups(w)) for side in words]
    telling = {g: e for g, n in groups[1].items() if (e := _evidence(n, groups[0][g], len(toxic), len(ordinary))) >= EVIDENCE}
    weight = {}
    for word in set().union(*words[1]):
        if hits := _groups({word}) & telling.keys():
            weight[word] = sum(telling[g] for g in hits) / (len(word) + 1)
    often, picked = Counter(), []
    for word, _ in sorted(weight.items(), key=lambda x: (-x[1], x[0])):
        new = [g for g in _groups({word}) & telling.keys() if often[g] < 3]
        if new:
            often.update(new)
            picked.append(word)
    own, _ = _packed([f" {w}" for w in picked], OWN_BYTES)
    counts = Counter(w for side in words[0] for w in side)
    ranked = [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))]
    shared, n = _packed(ranked, SHARED_BYTES)
    rest, _ = _packed(ranked[n:], len(own))
    return shared + rest + BEFORE, shared + own + BEFORE


def train(ordinary: list[str], toxic: list[str], share: float) -> Toxicity:
    """Dictionaries from two thirds of the texts, the calibration from the others."""
    if not ordinary or len(toxic) < 3:
        return Toxicity(constant=0.0 if len(toxic) < 3 else 1.0)
    learned, kept = zip(*(([t for i, t in enumerate(side) if i % 3], side[::3]) for side in (ordinary, toxic)))
    model = Toxicity(*dictionaries(*learned))
    features = np.array([model.features(t) for side in kept for t in side])
    marks = np.repeat([0.0, 1.0], [len(side) for side in kept])
    model.calibrated = fit(features, marks, share)
    return model


def trained(documents: DataFrame, labels: DataFrame) -> Toxicity:
    (ordinary, toxic), share = training_texts(documents, labels, "toxic", SAMPLES)
    return train(ordinary, toxic, share)


def toxicity(documents: DataFrame, model: Toxicity) -> DataFrame:
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
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
