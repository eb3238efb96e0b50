"""Exact notices in blocks that are long against the compression window."""

from __future__ import annotations

import random

import pytest

from pitlane.llm.license_scan import Scanner
from pitlane.llm.license_templates import TEMPLATES

LINE = 100
_RNG = random.Random(1)
VOCABULARY = ["".join(_RNG.choices("abcdefghijklmnopqrstuvwxyz", k=_RNG.randint(2, 9))) for _ in range(4000)]


def _words(rng: random.Random, n: int) -> str:
    return " ".join(rng.choices(VOCABULARY, k=n))


def _found(scanner: Scanner, text: str, name: str) -> bool:
    at = text.index(TEMPLATES[name])
    # Punctuation at its ends is not part of a licence's words.
    return any(f.license == name and f.differences == 0 and abs(f.start - at) <= 2 for f in scanner.scan(text))


@pytest.mark.parametrize("name", ["rights-reserved", "cc-by-4-short", "mit-notice", "isc-text", "bsd-3-text"])
@pytest.mark.parametrize("separator", ["\n", " "])
def test_exact_notices_at_every_depth_of_a_long_block(name, separator):
    """A few licence words on neighbouring long lines, or spread over one line, make a block of some 20,000 characters."""
    scanner, rng = Scanner(), random.Random(5)
    parts = [_words(rng, 250) + " license" for _ in range(15)]
    for depth in range(len(parts) + 1):
        before, after = parts[:depth], parts[depth:]
        text = separator.join([*before, TEMPLATES[name], *after])
        assert max(end - start for start, end in scanner.blocks(text)) > 15_000
        assert _found(scanner, text, name), (depth, len(text))


def test_notices_among_letters_of_several_bytes():
    scanner, rng = Scanner(), random.Random(6)
    parts = ["".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(LINE)) + " license" for _ in range(100)]
    for depth in (0, 50, 100):
        assert _found(scanner, "\n".join([*parts[:depth], TEMPLATES["rights-reserved"], *parts[depth:]]), "rights-reserved")


def test_pieces_cover_all_places():
    scanner = Scanner()
    longest = max(map(len, TEMPLATES.values()))
    for n in (0, 1, 5_000, 6_000, 23_456):
        data = random.Random(n).randbytes(n)
        pieces = scanner.pieces(data)
        assert pieces[0] == data[: len(pieces[0])] and data.endswith(pieces[-1])
        assert all(any(data[i : i + longest] in p for p in pieces) for i in range(0, max(n - longest, 1), 97))
