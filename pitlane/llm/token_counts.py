"""Token counts by a two-tier lookup on the map side.

Tier one is a broadcast table from frequent pre-tokens to their number of
tokens. Its misses go to a cache in each Python worker and from there to the
encoder, so each worker encodes a recurring pre-token about once. No pre-token
is shuffled; texts are not moved at all.

Nulls: a null text counts as empty, a null ``doc_id`` is kept. Repeated rows
give repeated rows. Columns other than these two are not read, so their names
cannot clash. An empty table gives an empty result. Very long texts are cut
into pieces at places no pre-token crosses.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitlane.llm import common

#: The pre-token pattern of this family of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: The broadcast table: entries, their greatest length in characters, and documents looked at to rank them.
TABLE_ENTRIES, TABLE_CHARS, TABLE_ROWS = 32_768, 48, 2_000
#: Entries of a worker's cache generation.
CACHE_ENTRIES = 200_000

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, n_pretokens bigint"


class PreTokens:
    """A tokenizer's special strings and pre-tokens."""

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        self.pattern = regex.compile(PATTERN)
        self.latin = common.latin_pattern(PATTERN)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = set(special)
        self.around = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")

    def pieces(self, text: str) -> Iterable[tuple[str, bool]]:
        """Parts of the text, and whether a part is a special string."""
        if "<|" not in text:
            yield from ((part, False) for part in common.cuts(text))
            return
        for part in self.around.split(text):
            if part in self.special:
                yield part, True
            else:
                yield from ((cut, False) for cut in common.cuts(part))

    def split(self, piece: str) -> list[str]:
        if common.is_latin(piece):
            return self.latin.findall(piece)
        if common.has_unassigned(piece):
            return [piece[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(piece)]
        return self.pattern.findall(piece)

    def lengths(self, pretokens: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(pretokens, add_special_tokens=False)]


_WORKER: dict[str, tuple[PreTokens, common.Recent[int]]] = {}


def _of_worker(definition: str) -> tuple[PreTokens, common.Recent[int]]:
    """One tokenizer and one cache for each Python worker process, whatever the task."""
    if definition not in _WORKER:
        _WORKER[definition] = PreTokens(definition), common.Recent(CACHE_ENTRIES)
    return _WORKER[definition]


def definition_of(path: str) -> str:
    """The tokenizer file, read where the driver runs, so that executors need no copy of it."""
    definition = Path(path).read_text(encoding="utf-8")
    if "ByteLevel" not in definition:
        raise ValueError(f"{path} is not a byte-level vocabulary")
    return definition


def frequent_lengths(
    documents: DataFrame, definition: str, rows: int = TABLE_ROWS, entries: int = TABLE_ENTRIES
) -> dict[str, int]:
    """Numbers of tokens of the commonest pre-tokens of about ``rows`` documents.

    The table only saves work: a pre-token that is not in it is counted as well,
    so which documents are drawn changes no result. ``entries`` times
    ``TABLE_CHARS`` bounds what is broadcast.
    """

    def start() -> common.Work:
        worker, _ = _of_worker(definition)

        def work(batch: pa.RecordBatch) -> dict[str, list]:
            seen: Counter[str] = Counter()
            for text in common.texts(batch):
                for piece, special in worker.pieces(text):
                    if not special:
                        seen.update(worker.split(piece))
            common_ones = [p for p in seen if len(p) <= TABLE_CHARS]
            return {"pretoken": common_ones, "n": [seen[p] for p in common_ones]}

        return work

    sample = common.drawn(documents.select("doc_id", "text"), rows, "doc_id", "text").select("text")
    counted = common.map_batches(sample, "pretoken string, n bigint", start)
    ranked = counted.groupBy("pretoken").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pretoken").limit(entries)
    pretokens = [r.pretoken for r in ranked.collect()]
    return dict(zip(pretokens, PreTokens(definition).lengths(pretokens), strict=True)) if pretokens else {}


def counter(worker: PreTokens, table: dict[str, int], cache: common.Recent[int]) -> Callable[[str], tuple[int, int]]:
    """A function from a text to its numbers of tokens and pre-tokens."""

    def count(text: str) -> tuple[int, int]:
        tokens = pretokens = 0
        missing: list[str] = []
        cached = cache.get
        for piece, special in worker.pieces(text):
            if special:
                tokens += 1
                pretokens += 1
                continue
            parts = worker.split(piece)
            pretokens += len(parts)
            for part, n in zip(parts, map(table.get, parts), strict=True):
                if n is None and (n := cached(part)) is None:
                    missing.append(part)
                else:
                    tokens += n
        if missing:
            times = Counter(missing)
            for part, n in zip(times, worker.lengths(list(times)), strict=True):
                tokens += n * times[part]
                if len(part) <= TABLE_CHARS:
                    cache.put(part, n)
        return tokens, pretokens

    return count


def token_counts(documents: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, n_pretokens, over_limit``."""
    definition = definition_of(path)
    table = documents.sparkSession.sparkContext.broadcast(frequent_lengths(documents, definition))

    def start() -> common.Work:
        worker, cache = _of_worker(definition)
        count = counter(worker, table.value, cache)

        def work(batch: pa.RecordBatch) -> dict[str, list | pa.Array]:
            found = [count(text) for text in common.texts(batch)]
            return {
                "doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"),
                "n_tokens": [n for n, _ in found], "n_pretokens": [n for _, n in found],
            }

        return work

    read = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        "text",
    )
    return common.map_batches(read, SCHEMA, start).withColumn("over_limit", F.col("n_tokens") > limit)
