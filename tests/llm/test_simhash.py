"""The grid join of fingerprints against all pairs, and fingerprints against their definition."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from pitlane.llm import simhash_grid
from pitlane.llm.simhash_grid import cells, fingerprint, unary


def by_definition(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "ÀB c\x0bd", "a b c", "a b c a b c a b c", "x\x1cy Z\xa0w q"])
def test_fingerprint(text):
    assert fingerprint(text) == by_definition(text)


def test_long_text_is_hashed_whole():
    rng = random.Random(5)
    text = " ".join(str(rng.randrange(900)) for _ in range(40_000))
    assert fingerprint(text) == by_definition(text)


def test_distances_of_points_never_exceed_those_of_fingerprints():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    y = x.copy()
    for _ in range(6):
        y ^= np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64) * rng.integers(0, 2, 4000).astype(np.uint64)
    assert (np.bitwise_count(unary(x) ^ unary(y)) <= np.bitwise_count(x ^ y)).all()
    segments = lambda v: [f"{int(v):064b}"[i : i + 2].count("1") for i in range(0, 64, 2)]
    manhattan = [sum(abs(p - q) for p, q in zip(segments(a), segments(b), strict=True)) for a, b in zip(x[:200], y[:200], strict=True)]
    assert np.bitwise_count(unary(x) ^ unary(y))[:200].tolist() == manhattan


def test_all_pairs_within_the_distance_meet_in_a_cell():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    y = x.copy()
    for i in range(3):
        y ^= np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)
    of_x, of_y = ([set() for _ in x] for _ in range(2))
    homes = [set(), set()]
    for side, (points, held) in enumerate(((x, of_x), (y, of_y))):
        for key, which, home in zip(*cells(unary(points)), strict=True):
            held[which].add(int(key))
            if home:
                homes[side].add((which, int(key)))
    for i, (a, b) in enumerate(zip(of_x, of_y, strict=True)):
        assert any((i, k) in homes[0] or (i, k) in homes[1] for k in a & b)


def _groups(codes: list[int]) -> list[int]:
    label = list(range(len(codes)))
    for i, a in enumerate(codes):
        for j in range(i):
            if (a ^ codes[j]).bit_count() <= 3 and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


@pytest.mark.parametrize("block", [1024, 16])
def test_links_connect_what_all_pairs_connect(spark, block, monkeypatch):
    monkeypatch.setattr(simhash_grid, "BLOCK", block)
    rng = random.Random(block)
    codes = {rng.getrandbits(64) for _ in range(150)} | {0, 1, 7, 15, 2**64 - 1}
    for _ in range(5):  # chains, and clusters denser than a block
        code = rng.getrandbits(64)
        for _ in range(60):
            code ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 3, 3, 4])))
            codes.add(code)
        centre = rng.getrandbits(64)
        codes |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 4]))) for _ in range(60)}
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    rows = spark.createDataFrame([(c,) for c in signed], "code long").repartition(3)
    links = simhash_grid.grid_links(rows).collect()
    at = {c: i for i, c in enumerate(signed)}
    label = list(range(len(codes)))
    for a, b in links:
        old, new = sorted((label[at[a]], label[at[b]]), reverse=True)
        label = [new if x == old else x for x in label]
    wanted = _groups(codes)
    assert len(set(zip(label, wanted, strict=True))) == len(set(label)) == len(set(wanted))


def test_rows(spark):
    words = [f"w{i}" for i in range(400)]
    near = [*words[:200], "other", *words[201:]]
    rows = [
        (5, " ".join(words)), (3, " ".join(words).upper()), (9, " ".join(near)), (None, " ".join(words)), (4, "alone in here now"),
        (8, None), (7, ""), (None, "nobody has this text"),
    ]
    found = {(r.doc_id, r.fingerprint): r.component_id for r in simhash_grid.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")
    ).collect()}
    codes = {i: f"{by_definition(t):016x}" for i, t in rows if i}
    assert found[5, codes[5]] == found[3, codes[3]] == found[None, codes[5]] == 3
    assert found[8, "0" * 16] == found[7, "0" * 16] == 7 and found[4, codes[4]] == 4
    linked = (by_definition(rows[0][1]) ^ by_definition(rows[2][1])).bit_count() <= 3
    assert found[9, codes[9]] == (3 if linked else 9)
    assert None in [v for (i, _), v in found.items() if i is None]
