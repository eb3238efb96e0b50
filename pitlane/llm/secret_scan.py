"""Secret scans: fixed patterns, and character Markov models of random strings and ordinary identifiers.

Two models of character pairs are trained from labelled samples. Random: the
values that the fixed patterns found in a sample of documents, and strings drawn
from the alphabets of keys. Ordinary: the other words of those documents, alone
and joined as identifiers are, without those that already look random. In a run
of key characters, less what the fixed patterns found, the part whose
log-likelihood ratio is greatest is a secret if that is above the threshold of
its length, which lies between held-out samples of both kinds; at most one in
``FALSE_ALARMS`` of the ordinary ones passes it.

Only the sample, of bounded size, comes to the driver. Scanning moves no row.

Nulls: a null text is empty, a null ``doc_id`` is kept. Repeated rows give
repeated rows, empty texts no spans; other columns are not read; an empty table
gives an empty result (the ordinary model is then trained on key words alone).
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm import common

#: Documents looked at for training, and samples kept of each kind.
SAMPLE_ROWS, SAMPLE_STRINGS = 2_000, 20_000
FALSE_ALARMS = 10_000
#: Shortest run of key characters that the models judge, and longest one used in training.
SHORTEST, LONGEST = 16, 200
#: Least lengths of the classes that have a threshold each, and how often the ordinary sample is cleaned.
LENGTHS, CLEANINGS = (SHORTEST, 24, 32, 48), 2
#: Characters that part the words of paths and identifiers.
MARKS = "/_=-+"
SEED = 7
KINDS = ("assign", "access", "hex", "markov")

#: The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")
KEYWORDS = ("passw", "secret", "token", "api")
RUN = re.compile(f"[A-Za-z0-9+/_=-]{{{SHORTEST},}}")
WORDS = re.compile("[A-Za-z0-9+/_=-]{3,}")

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=.-"
_CODES = np.full(128, len(ALPHABET), np.int64)
_CODES[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of what the fixed patterns find, leftmost first in each kind."""
    found = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        # ASCII letters only: IGNORECASE would else fold further letters into s and k.
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _class(length: int) -> int:
    """The class of a length: the last of ``LENGTHS`` that it reaches."""
    return bisect_right(LENGTHS, length) - 1


@dataclass
class Markov:
    """Log-likelihood ratios of character pairs, random against ordinary, and the threshold of their sum by length."""

    ratio: np.ndarray
    thresholds: list[float]

    @property
    def threshold(self) -> float:
        """The threshold of the shortest class."""
        return self.thresholds[0]

    def pairs(self, run: str) -> np.ndarray:
        codes = np.concatenate(([len(ALPHABET)], _CODES[np.frombuffer(run.encode("ascii"), np.uint8)]))
        return self.ratio[codes[:-1], codes[1:]]

    def score(self, run: str) -> float:
        return float(self.pairs(run).sum())

    def best(self, run: str) -> tuple[int, int, float]:
        """Start, end and score of the part of at least ``SHORTEST`` characters whose sum is greatest."""
        total = np.concatenate(([0.0], np.cumsum(self.pairs(run))))
        heads = total[: len(total) - SHORTEST]
        sums = total[SHORTEST:] - np.minimum.accumulate(heads)
        last = int(sums.argmax())
        return int(heads[: last + 1].argmin()), last + SHORTEST, float(sums[last])

    def passes(self, length: int, score: float) -> bool:
        return score > self.thresholds[_class(length)]

    def found(self, run: str) -> list[tuple[int, int]]:
        """The secrets of a run: all of it, or its best parts, up to the marks that part words."""
        spans, todo = [], [(0, len(run))]
        while todo:
            low, high = todo.pop()
            if high - low < SHORTEST:
                continue
            start, end, score = self.best(run[low:high])
            if not self.passes(end - start, score):
                continue
            if self.passes(high - low, self.score(run[low:high])):
                spans.append((low, high))
                continue
            start, end = low + start, low + end
            while start > low and run[start - 1] not in MARKS:
                start -= 1
            while end < high and run[end] not in MARKS:
                end += 1
            spans.append((start, end))
            todo += [(low, start), (end, high)]
        return sorted(spans)

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """All spans of the text: the fixed patterns', and what the models find in runs outside of them."""
        base = base_spans(text)
        own = []
        for m in RUN.finditer(text):
            for low, high in _left_of(m.start(), m.end(), base):
                own += [(low + s, 3, low + e) for s, e in self.found(text[low:high])]
        return sorted(base + own)


def _left_of(start: int, end: int, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What is left of a stretch outside of ``spans``, which are sorted, in parts of at least ``SHORTEST``."""
    left, at = [], start
    for s, _, e in spans:
        if e > at and s < end:
            left.append((at, s))
            at = e
    return [(s, e) for s, e in [*left, (at, end)] if e - s >= SHORTEST]


def _counts(samples: list[str]) -> np.ndarray:
    n = len(ALPHABET) + 1
    counts = np.full((n, n), 0.5)
    for sample in samples:
        codes = np.concatenate(([n - 1], _CODES[np.frombuffer(sample[:LONGEST].encode("ascii"), np.uint8)]))
        np.add.at(counts, (codes[:-1], codes[1:]), 1)
    return np.log(counts / counts.sum(1, keepdims=True))


def _drawn_keys(rng: random.Random, n: int) -> list[str]:
    letters, digits = ALPHABET[:52], ALPHABET[52:62]
    alphabets = ("0123456789abcdef", letters + digits, letters[26:] + digits, letters[:26] + digits, ALPHABET[:64],
                 letters + digits + "_-")
    return ["".join(rng.choices(rng.choice(alphabets), k=rng.randint(SHORTEST, 64))) for _ in range(n)]


def _identifiers(rng: random.Random, words: list[str], n: int) -> list[str]:
    """Words alone and joined in the manners of code, paths and keys of settings."""
    if not words:
        return []
    made = []
    for _ in range(n):
        picked = rng.choices(words, k=rng.randint(1, 5))
        manner = rng.randrange(5)
        joined = (
            "".join(p.capitalize() for p in picked) if manner == 0 else ("_", "-", "/", "")[manner - 1].join(picked)
        )
        made.append(joined + (str(rng.randrange(10_000)) if rng.random() < 0.2 else ""))
    return [m for m in made if len(m) >= SHORTEST]


def train(random_values: list[str], ordinary_words: list[str]) -> Markov:
    """The models and the thresholds; a fifth of the samples of either kind is held out for the thresholds.

    Words of documents whose best part scores half as much as random strings do may
    be unlabelled secrets; they are taken out of the ordinary sample, and the models fitted
    again. Thresholds are set for classes of length, each halfway between
    what one in ``FALSE_ALARMS`` ordinary samples passes and what all but one in a
    hundred random ones pass, but not below the former.
    """
    rng = random.Random(SEED)
    words = sorted(set(ordinary_words)) or list(KEYWORDS)
    keys = sorted(set(random_values)) + _drawn_keys(rng, SAMPLE_STRINGS)
    by_class = [[k for k in keys[::5] if _class(len(k)) == c] for c in range(len(LENGTHS))]
    of_keys = _counts([k for i, k in enumerate(keys) if i % 5])
    for last in [False] * CLEANINGS + [True]:
        made = _identifiers(random.Random(SEED), words, 2 * SAMPLE_STRINGS)
        ordinary = [w for w in words if len(w) >= SHORTEST] + made
        model = Markov(of_keys - _counts([o for i, o in enumerate(ordinary) if i % 5] + words), [])
        lows = []
        for members in by_class:
            scores = sorted(model.score(k) for k in members)
            lows.append(max([scores[len(scores) // 100] if scores else 0.0, *lows[-1:]]))
        if not last:
            words = [w for w in words if len(w) < SHORTEST or not _like_random(model, w, lows)] or list(KEYWORDS)
    parts = [(_class(end - start), score) for start, end, score in map(model.best, ordinary[::5])]
    high = 0.0
    for c, low in enumerate(lows):
        scores = sorted(score for of, score in parts if of == c)
        high = max([high, *scores[-1 - len(scores) // FALSE_ALARMS :][:1]])
        model.thresholds.append(max(high, (high + low) / 2) + 1e-9)
    return model


def _like_random(model: Markov, word: str, lows: list[float]) -> bool:
    """Whether a word's best part is nearer to what all but one in a hundred random strings score than to nothing."""
    start, end, score = model.best(word)
    return 2 * score > lows[_class(end - start)]


def samples(documents: DataFrame) -> tuple[list[str], list[str]]:
    """Labelled strings of about ``SAMPLE_ROWS`` documents: values of the fixed patterns, and other words."""

    def start() -> common.Work:
        def work(batch: pa.RecordBatch) -> dict[str, list]:
            keys, words = set(), set()
            for text in common.texts(batch):
                spans = base_spans(text)
                for s, kind, e in spans:
                    value = ASSIGN.match(text, s)[2] if kind == 0 else text[s:e]
                    if len(value) >= SHORTEST:
                        keys.add(value[:LONGEST])
                for m in WORDS.finditer(text):
                    if not any(s < m.end() and m.start() < e for s, _, e in spans):
                        words.add(m[0][:LONGEST])
            return {"value": [*keys, *words], "secret": [True] * len(keys) + [False] * len(words)}

        return work

    # Told apart by text as well, so ids that are null or repeat do not come in bulk; equal rows count once.
    drawn = common.drawn(documents.select("doc_id", "text"), SAMPLE_ROWS, "doc_id", "text").select("text").distinct()
    found = common.map_batches(drawn, "value string, secret boolean", start).distinct()
    kept = [
        found.filter(F.col("secret") == kind).orderBy(F.xxhash64("value"), "value").limit(SAMPLE_STRINGS)
        for kind in (True, False)
    ]
    rows = kept[0].unionAll(kept[1]).collect()
    return [r.value for r in rows if r.secret], [r.value for r in rows if not r.secret]


def trained(documents: DataFrame) -> Markov:
    return train(*samples(documents))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join([f"{KINDS[kind]}:{s}:{e}" for s, kind, e in spans])


SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_markov bigint, base_sha256 string, spans string"


def scan(documents: DataFrame, model: Markov | None = None) -> DataFrame:
    """One row per document: counts by kind, the digest of the base spans, and all spans."""
    shipped = documents.sparkSession.sparkContext.broadcast(model or trained(documents))

    def start() -> common.Work:
        find = shipped.value.spans

        def work(batch: pa.RecordBatch) -> dict[str, list | pa.Array]:
            spans = [find(text) for text in common.texts(batch)]
            base = [joined([s for s in found if s[1] < 3]) for found in spans]
            return {
                "doc_id": batch.column("doc_id"),
                **{f"n_{k}": [sum(s[1] == i for s in found) for found in spans] for i, k in enumerate(KINDS)},
                "base_sha256": [hashlib.sha256(b.encode()).hexdigest() for b in base],
                "spans": [joined(found) for found in spans],
            }

        return work

    return common.map_batches(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), SCHEMA, start)


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with each stretch that spans cover replaced by ``mark``."""
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def without_secrets(documents: DataFrame, model: Markov | None = None) -> DataFrame:
    """All documents and all their columns, with secrets replaced and ``n_chars``, if there, counted anew."""
    shipped = documents.sparkSession.sparkContext.broadcast(model or trained(documents))
    schema = documents.schema

    def start() -> common.Work:
        find = shipped.value.spans

        def work(batch: pa.RecordBatch) -> dict[str, list | pa.Array]:
            given = batch.column("text").to_pylist()
            return {name: batch.column(name) for name in schema.names} | {
                "text": [t and redacted(t, find(t)) for t in given]
            }

        return work

    cleaned = common.map_batches(documents, schema, start)
    if "n_chars" in schema.names:
        kind = schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return cleaned
