"""Byte-pair encoding with word ends, by a heap of merge ranks over a doubly linked symbol list.

A word's symbols form a linked list kept in two index arrays. The heap holds
(rank, place, left, right) of every neighbouring pair that can merge; an entry
whose place no longer holds that pair is stale and skipped. A word of n symbols
takes O(n log n). Texts are normalised by the tokenizer file's own normaliser.
Decoding concatenates the vocabulary's strings, with a space between tokens, as
the library does for a file without a decoder.

Nulls: a null text is encoded as the empty one, a null ``doc_id`` is kept.
Repeated rows give repeated rows; an empty table gives an empty result; other
columns are not read. Very long texts are encoded in pieces, very long words as
a whole.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import normalizers, pre_tokenizers

from pitlane.llm import common

#: Entries of a worker's cache generation, and the longest word kept in it.
CACHE_ENTRIES, CACHE_CHARS = 200_000, 64

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in own}
    for n, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + n)
    return [letters[b] for b in range(256)]


class WordBpe:
    """Encoder and decoder of one tokenizer file of kind word-end BPE."""

    def __init__(self, definition: str):
        file = json.loads(definition)
        model = file["model"]
        self.suffix: str = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        special: dict[str, int] = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.strings = {i: s for s, i in (vocab | special).items()}
        self.special = special
        self.around = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
        self.inner = [vocab[c] for c in byte_letters()]
        self.last = [vocab[c + self.suffix] for c in byte_letters()]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[vocab[a], vocab[b]] = rank, vocab[a + b]
        self.normalizer = normalizers.Sequence([
            normalizers.NFC(), normalizers.Replace(_pattern(r"\s+"), " "), normalizers.Lowercase(),
        ])
        split = next(p for p in file["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.words = regex.compile(split)
        self.own_split = pre_tokenizers.Split(_pattern(split), "removed", invert=True)
        self.latin_words = common.latin_pattern(split)
        self.cache: common.Recent[tuple[bytes, str]] = common.Recent(CACHE_ENTRIES)
        self.runs: common.Recent[tuple[bytes, str]] = common.Recent(CACHE_ENTRIES)

    def merged(self, symbols: list[int]) -> list[int]:
        """The symbols after all merges, the one of lowest rank and then the leftmost first."""
        n, merges = len(symbols), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = merges.get((symbols[i], symbols[i + 1]))
            if found:
                heap.append((found[0], i, symbols[i], symbols[i + 1]))
        heapify(heap)
        while heap:
            _, i, left, right = heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i] = merges[left, right][1]
            symbols[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = merges.get((symbols[i], symbols[k]))
                if found:
                    heappush(heap, (found[0], i, symbols[i], symbols[k]))
            h = before[i]
            if h >= 0:
                found = merges.get((symbols[h], symbols[i]))
                if found:
                    heappush(heap, (found[0], h, symbols[h], symbols[i]))
        return [s for s in symbols if s >= 0]

    def word(self, word: str) -> tuple[bytes, str]:
        """A word's ids, four bytes each, and its vocabulary strings."""
        found = self.cache.get(word)
        if found is None:
            symbols = [self.inner[b] for b in word.encode()]
            symbols[-1] = self.last[word.encode()[-1]]
            ids = self.merged(symbols)
            found = _packed(ids), " ".join([self.strings[i] for i in ids])
            if len(word) <= CACHE_CHARS:
                self.cache.put(word, found)
        return found

    def parts(self, text: str) -> Iterator[list[tuple[bytes, str]]]:
        """The encoded words of the text, a bounded piece of it at a time."""
        for raw in self.around.split(text) if "<|" in text else [text]:
            if raw in self.special:
                yield [(_packed([self.special[raw]]), raw)]
                continue
            for cut in common.cuts(raw):
                if common.is_latin(cut) and not any(c in cut for c in _SEPARATORS):
                    young = self.runs.young.get
                    yield [young(r) or self.run(r) for r in cut.lower().split()]
                    continue
                normal = self.normalizer.normalize_str(cut)
                if common.has_unassigned(normal):
                    words = [w for w, _ in self.own_split.pre_tokenize_str(normal)]
                else:
                    words = self.words.findall(normal)
                yield [self.word(w) for w in words]

    def run(self, run: str) -> tuple[bytes, str]:
        """What stands between white space, of code points below 256 and in lower case.

        Such a text is its own composed form, and no word reaches over white space.
        """
        found = self.runs.get(run)
        if found is None:
            words = [self.word(w) for w in self.latin_words.findall(run)]
            found = b"".join([ids for ids, _ in words]), " ".join([strings for _, strings in words])
            if len(run) <= CACHE_CHARS:
                self.runs.put(run, found)
        return found

    def encode(self, text: str) -> list[int]:
        return [i for part in self.parts(text) for packed, _ in part for i in _unpacked(packed)]

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.strings[i] for i in ids])

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, and the digests of the ids and of the decoded text.

        Decoding concatenates the same vocabulary strings that ``decode`` looks
        up, a word at a time, so neither the ids nor the text are kept whole.
        """
        n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for part in self.parts(text):
            if part:
                packed = b"".join([ids for ids, _ in part])
                strings = " ".join([strings for _, strings in part])
                ids.update(packed)
                decoded.update((" " + strings if n else strings).encode())
                n += len(packed) // 4
        return n, ids.hexdigest(), decoded.hexdigest()


def _pattern(text: str):
    from tokenizers import Regex

    return Regex(text)


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if packed.itemsize != 4:
        packed = array("L", ids)
    if _BIG:
        packed.byteswap()
    return packed.tobytes()


def _unpacked(packed: bytes) -> list[int]:
    return [int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4)]


#: Split at by Python's ``split``, but no white space to the tokenizer.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_BIG = array("H", [1]).tobytes() == b"\0\1"
_WORKER: dict[str, WordBpe] = {}


def of_worker(definition: str) -> WordBpe:
    if definition not in _WORKER:
        _WORKER[definition] = WordBpe(definition)
    return _WORKER[definition]


def encode_and_decode(documents: DataFrame, path: str) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    definition = documents.sparkSession.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))

    def start() -> common.Work:
        model = of_worker(definition.value)

        def work(batch: pa.RecordBatch) -> dict[str, list | pa.Array]:
            n, ids, decoded = [], [], []
            for text in common.texts(batch):
                a, b, c = model.digests(text)
                n.append(a)
                ids.append(b)
                decoded.append(c)
            return {"doc_id": batch.column("doc_id"), "n_tokens": n, "ids_sha256": ids, "decoded_sha256": decoded}

        return work

    read = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return common.map_batches(read, SCHEMA, start)


def encoded(documents: DataFrame, path: str) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids array<int>, decoded_sha256``."""
    definition = documents.sparkSession.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))

    def start() -> common.Work:
        model = of_worker(definition.value)

        def work(batch: pa.RecordBatch) -> dict[str, list | pa.Array]:
            packed, decoded = [], []
            for text in common.texts(batch):
                parts = list(model.parts(text))
                packed.append(b"".join([ids for part in parts for ids, _ in part]))
                strings = " ".join([strings for part in parts for _, strings in part])
                decoded.append(hashlib.sha256(strings.encode()).hexdigest())
            sizes = np.array([len(p) // 4 for p in packed], np.int64)
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            ids = np.frombuffer(b"".join(packed), "<i4").astype(np.int32)
            return {
                "doc_id": batch.column("doc_id"), "n_tokens": pa.array(sizes),
                "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)), "decoded_sha256": decoded,
            }

        return work

    read = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return common.map_batches(read, "doc_id bigint, n_tokens bigint, ids array<int>, decoded_sha256 string", start)
