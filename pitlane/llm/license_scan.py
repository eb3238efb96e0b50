"""License scans by conditional compression.

Lines that hold a word of licences, with those close to them, form candidate
blocks. A block is compressed plainly and with each template as a raw
dictionary, in overlapping pieces short enough for the dictionary to tell;
templates are ranked by the most bytes they save in a piece. In that order each is
held against the block word by word: the first whose wording differs by no more
than its allowance wins its stretch of the block. What is left of the block
goes through the same again, so several licences in a block are all found.

Documents are scanned where they lie; templates, a fixed and small list, go to
all workers. Blocks are bounded, also on very long lines: a line is seen in
stretches around its licence words that any template fits in.

Nulls: a null text has no blocks, a null ``doc_id`` is kept. Repeated rows give
repeated rows; empty texts no licences; other columns are not read; an empty
table gives an empty result. Of two templates that save the same, the one of
lesser name comes first.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm import common
from pitlane.llm.license_templates import TEMPLATES
from pitlane.llm.zstd_models import lengths

#: Hundredths of a template's words that may differ, and the words up to which none may.
ALLOWED, STRICT_WORDS = 10, 20
#: Least share (in hundredths) of its own compressed size that a template must save to be compared.
SAVED = 25
#: Lines between candidate lines that still belong to one block.
GAP = 3
#: Bytes of a piece besides twice the reach, so that the stretch around one licence word is one piece.
PIECE_EDGE = 256

_ANCHOR = re.compile(
    r"licen[sc]e|copyright|rights reserved|permission|warrant|redistribut|creative commons|public domain|\bcc by\b",
    re.IGNORECASE,
)
_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Found:
    """A licence in a text: its template, place, and the words by which the wording differs."""

    license: str
    start: int
    end: int
    differences: int
    saved: int

    def __str__(self) -> str:
        return f"{self.license}:{self.start}:{self.end}:{self.differences}"


class Scanner:
    def __init__(self, templates: dict[str, str] = TEMPLATES):
        self.words = {name: [w.lower() for w in _WORD.findall(text)] for name, text in templates.items()}
        self.reach = 2 * max([len(t) for t in templates.values()], default=0)
        window = max(4 * self.reach, 256)
        self.plain = lengths(b"", window)
        self.given = {name: lengths(text.encode(), window) for name, text in sorted(templates.items())}
        self.own = {name: self.plain(text.encode()) for name, text in templates.items()}

    def blocks(self, text: str) -> list[tuple[int, int]]:
        """Stretches around licence words: whole lines, or parts of very long ones."""
        stretches: list[list[int]] = []
        for m in _ANCHOR.finditer(text):
            start = max(text.rfind("\n", 0, m.start()) + 1, m.start() - self.reach)
            end = text.find("\n", m.end())
            end = min(len(text) if end < 0 else end, m.end() + self.reach)
            if stretches and (
                start <= stretches[-1][1] or text.count("\n", stretches[-1][1], start) <= GAP
                and start - stretches[-1][1] <= self.reach
            ):
                if end - stretches[-1][0] <= 8 * self.reach:
                    stretches[-1][1] = max(end, stretches[-1][1])
                    continue
                # A long block goes on in another one that overlaps it by more than any template.
                start = max(start - self.reach, 0)
            stretches.append([start, end])
        return [(s, e) for s, e in stretches]

    def pieces(self, data: bytes) -> list[bytes]:
        """``data`` in pieces that overlap by more than any template: the dictionary is of no use to longer ones."""
        size, step = 2 * self.reach + PIECE_EDGE, max(self.reach, 1)
        return [data[at : at + size] for at in range(0, max(len(data) - size, 0) + step, step)]

    def ranked(self, block: str) -> list[tuple[int, str]]:
        """``(bytes saved, template)`` of templates that save enough in some piece, most first."""
        pieces = [(piece, self.plain(piece)) for piece in self.pieces(block.encode())]
        saved = [(max(plain - given(piece) for piece, plain in pieces), name) for name, given in self.given.items()]
        return sorted(
            ((n, name) for n, name in saved if 100 * n >= SAVED * self.own[name]), key=lambda x: (-x[0], x[1])
        )

    def wording(self, template: list[str], words: list[str]) -> tuple[int, int, int] | None:
        """First and last word of the stretch that is closest to the template, and the differing words, if allowed."""
        n = len(template)
        allowed = 0 if n < STRICT_WORDS else n * ALLOWED // 100
        for at in (i for i, w in enumerate(words) if w == template[0]):
            if words[at : at + n] == template:
                return at, at + n, 0
        if not allowed:
            return None
        matcher = SequenceMatcher(None, template, words, autojunk=False)
        longest = matcher.find_longest_match(0, n, 0, len(words))
        if not longest.size:
            return None
        low = max(longest.b - longest.a - allowed, 0)
        part = words[low : longest.b - longest.a + n + allowed]
        same = [m for m in SequenceMatcher(None, template, part, autojunk=False).get_matching_blocks() if m.size]
        first, last = same[0].b, same[-1].b + same[-1].size
        matched = sum(m.size for m in same)
        differing = (n - matched) + (last - first - matched)
        return (low + first, low + last, differing) if differing <= allowed else None

    def first_in(self, text: str, start: int, end: int) -> Found | None:
        """The licence of highest rank whose wording is allowed."""
        block = text[start:end]
        spans = [(start + m.start(), start + m.end()) for m in _WORD.finditer(block)]
        words = [text[a:b].lower() for a, b in spans]
        for saved, name in self.ranked(block):
            stretch = self.wording(self.words[name], words)
            if stretch:
                first, last, differing = stretch
                return Found(name, spans[first][0], spans[last - 1][1], differing, saved)
        return None

    def scan(self, text: str) -> list[Found]:
        """All licences, in the order of the text; none overlaps another."""
        todo, found = self.blocks(text), []
        while todo:
            start, end = todo.pop()
            licence = self.first_in(text, start, end)
            if licence:
                found.append(licence)
                todo += [(start, licence.start), (licence.end, end)]
        apart: list[Found] = []
        for licence in sorted(found, key=lambda x: (x.start, -x.end)):
            if not apart or licence.start >= apart[-1].end:
                apart.append(licence)
        return apart


_WORKER: dict[tuple, Scanner] = {}


def _of_worker(templates: dict[str, str]) -> Scanner:
    key = tuple(sorted(templates.items()))
    if key not in _WORKER:
        _WORKER[key] = Scanner(templates)
    return _WORKER[key]


def licenses(documents: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row per document: ``doc_id, n_blocks, n_licenses, license, saved_bytes, n_differences, licenses``.

    ``licenses`` lists all as ``template:start:end:differences`` in code points;
    ``license`` is the one that saved most, null if there is none.
    """

    def start() -> common.Work:
        scanner = _of_worker(templates)

        def work(batch: pa.RecordBatch) -> dict[str, list | pa.Array]:
            texts = common.texts(batch)
            found = [scanner.scan(t) for t in texts]
            best = [min(f, key=lambda x: (-x.saved, x.license, x.start), default=None) for f in found]
            return {
                "doc_id": batch.column("doc_id"),
                "n_blocks": [len(scanner.blocks(t)) for t in texts],
                "n_licenses": [len(f) for f in found],
                "license": [b and b.license for b in best],
                "saved_bytes": [b and b.saved for b in best],
                "n_differences": [b and b.differences for b in best],
                "licenses": [",".join(map(str, f)) for f in found],
            }

        return work

    read = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return common.map_batches(
        read, "doc_id bigint, n_blocks bigint, n_licenses bigint, license string, saved_bytes bigint, "
        "n_differences bigint, licenses string", start,
    )
