"""Sets of hashed word shingles, signatures of them, and their similarity, on whole arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Words of a shingle.
WORDS = 5
#: Positions of a signature and bits of each.
POSITIONS, BITS = 48, 16

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_LOWER += np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all hang on all bits of ``x``."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _numbers(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_PLACES = _numbers(64, 11)
_IN_SHINGLE = _numbers(WORDS, 23) | np.uint64(1)
_OF_POSITION = _numbers(POSITIONS, 37) | np.uint64(1)


def _places(n: int) -> np.ndarray:
    return _PLACES[:n] if n <= len(_PLACES) else _numbers(n, 11)


def word_hashes(text: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of UTF-8 bytes, letters A to Z in lower case."""
    space = _SPACE[text]
    before = np.concatenate(([True], space[:-1]))
    starts = np.flatnonzero(before & ~space)
    if not len(starts):
        return np.zeros(0, np.uint64)
    index = np.arange(len(text))
    place = index - np.repeat(starts, np.diff(np.append(starts, len(text))), axis=0) if starts[0] == 0 else (
        index[starts[0]:] - np.repeat(starts, np.diff(np.append(starts, len(text))))
    )
    inside = ~space[starts[0]:]
    place = np.where(inside, place, 0)
    with np.errstate(over="ignore"):
        value = np.where(inside, _LOWER[text[starts[0]:]] * _places(int(place.max()) + 1)[place], np.uint64(0))
        return np.add.reduceat(value, starts - starts[0])


def shingle_set(text: np.ndarray) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; of its whole sequence, if that is shorter; or none."""
    words = word_hashes(text)
    n = len(words)
    with np.errstate(over="ignore"):
        if n >= WORDS:
            total = sum(words[i : n - WORDS + 1 + i] * _IN_SHINGLE[i] for i in range(WORDS))
        elif n:
            total = np.array([np.sum(words * _IN_SHINGLE[:n]) + np.uint64(n)], np.uint64)
        else:
            return words
    return np.unique(_mixed(total))


def class_of(shingles: np.ndarray) -> int:
    """One number for a set: documents of equal sets form a class. 64 bits wide."""
    return xxhash.xxh64_intdigest(shingles.tobytes()) - (1 << 63)


def signature(shingles: np.ndarray) -> np.ndarray:
    """For each position, ``BITS`` bits of the shingle that is least in the position's order."""
    least = np.full(POSITIONS, np.iinfo(np.uint64).max)
    with np.errstate(over="ignore"):
        for i in range(0, len(shingles), 2048):
            part = shingles[i : i + 2048, None] * _OF_POSITION[None, :]
            least = np.minimum(least, part.min(0))
    return (_mixed(least) & np.uint64((1 << BITS) - 1)).astype(np.uint16)


#: Positions of a fine signature, one byte each, and the least equal ones of two sets that may be similar: at a
#: similarity of 0.75, 384 are equal on average, and fewer than 300 with odds of 1 in 10^16, which is what the 64-bit
#: hashes of sets and shingles are good for as well. All that may be similar is compared on full sets.
FINE, FINE_EQUAL = 512, 300
_OF_FINE = (_numbers(FINE, 53) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def fine_signature(shingles: np.ndarray) -> np.ndarray:
    """A longer signature, by 32-bit hashes, that tells similar from nearly similar."""
    least = np.full(FINE, np.iinfo(np.uint32).max, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    with np.errstate(over="ignore"):
        for i in range(0, len(short), 512):
            least = np.minimum(least, (short[i : i + 512, None] * _OF_FINE[None, :]).min(0))
    return (_mixed(least.astype(np.uint64)) & np.uint64(255)).astype(np.uint8)


def similar(a: np.ndarray, b: np.ndarray, hundredths: int = 75) -> bool:
    """Whether two sets share so many hundredths of their union."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < hundredths * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= hundredths * (len(a) + len(b) - both)


def byte_texts(column: pa.Array) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each text of an Arrow column; null is empty."""
    for value in column.cast(pa.large_binary()):
        buffer = value.as_buffer() if value.is_valid else None
        yield np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
