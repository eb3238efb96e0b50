"""Near-duplicates against all pairs, and components against a simple search."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from llm.conftest import WORDS, prose
from pitlane.llm import neardup, shingles
from pitlane.llm.components import components


def _slow_sets(texts: dict[int, str]) -> dict[int, set]:
    def of(text: str) -> set:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        if len(words) < 5:
            return {tuple(words)} if words else set()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    return {i: of(t) for i, t in texts.items()}


def _slow_components(nodes, links) -> dict:
    label = {n: n for n in nodes}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    return {n: root(n) for n in nodes}


def _expected(texts: dict[int, str]) -> dict[int, int]:
    sets = _slow_sets(texts)
    ids = sorted(texts)
    links = [
        (a, b) for i, a in enumerate(ids) for b in ids[i + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return _slow_components(ids, links)


def _texts(seed: int) -> dict[int, str]:
    """Copies, chains of edits, a passage that many share, and a large group of near copies."""
    rng = random.Random(seed)
    passage = prose(rng, 40)
    texts, base = [], prose(rng, 300)
    for _ in range(60):
        words = base.split()
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(len(words))] = "edit" + str(rng.randrange(10**6))
        texts.append(" ".join(words))
    texts += [passage + " " + " ".join(rng.choice(WORDS) + str(rng.randrange(99)) for _ in range(rng.randrange(5, 80)))
              for _ in range(60)]
    chain = prose(rng, 120).split()
    for i in range(15):
        chain[(i * 7) % 120] = f"step{i}"
        texts.append(" ".join(chain))
    texts += [base] * 5 + [base.upper(), "", "a b", "A  b", "a b c d e", "a b c d e f"]
    rng.shuffle(texts)
    return dict(enumerate(texts, 100))


@pytest.mark.parametrize(("seed", "block"), [(1, 1024), (2, 7)])
def test_all_pairs(spark, monkeypatch, seed, block):
    """Small blocks send ordinary buckets the way of large ones."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    texts = _texts(seed)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    found = {r.doc_id: r for r in neardup.near_duplicates(df).collect()}
    assert {i: r.component_id for i, r in found.items()} == _expected(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.values())
    sets = _slow_sets(texts)
    assert {i: r.n_shingles for i, r in found.items()} == {i: len(s) for i, s in sets.items()}
    left = {r.doc_id for r in neardup.without_near_duplicates(df).collect()}
    assert left == set(_expected(texts).values())


def test_links_inside_blocks(spark, monkeypatch):
    """Every pair within the distance is met in a bucket dealt out in blocks; links connect the labels that full sets do."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 16, shingles.POSITIONS, dtype=np.uint16)
    fine = rng.integers(0, 256, shingles.FINE, dtype=np.uint8)
    known, close = {}, {}
    for i in range(60):
        known[i], close[i] = base.copy(), fine.copy()
        where = rng.choice(shingles.POSITIONS, rng.integers(0, 20), replace=False)
        known[i][where] = rng.integers(0, 1 << 16, len(where), dtype=np.uint16)
        where = rng.choice(shingles.FINE, rng.integers(0, 150), replace=False)
        close[i][where] += 1 + i % 2
    classes = spark.createDataFrame([(i, s.tobytes()) for i, s in known.items()], "class long, signature binary")
    keys = neardup.bucket_keys(classes).toPandas()
    sizes = keys.groupby("key").size()
    rows = [(k, int(sizes[k]), c, c % 7, known[c].tobytes(), close[c].tobytes()) for k, c in zip(keys["key"], keys["class"])]
    monkeypatch.setattr(neardup, "BLOCK", 8)
    df = spark.createDataFrame(rows, "key long, size long, class long, label long, signature binary, fine binary")
    candidates = {
        (i, j) for i in known for j in known
        if i < j and i % 7 != j % 7 and np.count_nonzero(known[i] != known[j]) <= neardup.DISTANCE
        and np.count_nonzero(close[i] == close[j]) >= shingles.FINE_EQUAL
    }
    rows = neardup.involved(df).drop("low", "high", "own").distinct()
    assert {r["class"] for r in rows.collect()} == {i for pair in candidates for i in pair}
    assert neardup.involved(df).count() <= neardup.dealt(df).count()
    # Sets are similar within five kinds.
    kinds = [np.sort(rng.integers(0, 1 << 63, 40, dtype=np.uint64)).tobytes() for _ in range(5)]
    sets = spark.createDataFrame([(i, kinds[i % 5]) for i in known], "class long, shingles binary")
    links = {(r.a, r.b) for r in neardup.links_inside(neardup.involved(df).join(sets, "class")).collect()}
    wanted = {(i % 7, j % 7) for i, j in candidates if i % 5 == j % 5}
    assert _slow_components(set(range(7)), list(links)) == _slow_components(set(range(7)), list(wanted))
    assert any(sizes > 8) and links and all(a != b for a, b in links)


def test_guarantee(spark):
    """Any two signatures within the distance share a key."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(40):
        s = rng.integers(0, 1 << 16, shingles.POSITIONS, dtype=np.uint16)
        t = s.copy()
        t[rng.choice(shingles.POSITIONS, neardup.DISTANCE, replace=False)] += 1
        rows += [(2 * i, s.tobytes()), (2 * i + 1, t.tobytes())]
    keys = neardup.bucket_keys(spark.createDataFrame(rows, "class long, signature binary")).collect()
    of = {}
    for r in keys:
        of.setdefault(r["class"], set()).add(r.key)
    assert all(len(k) == shingles.POSITIONS for k in of.values())
    assert all(of[2 * i] & of[2 * i + 1] for i in range(40))


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)]
    links += [(200, 200 + i) for i in range(1, 20)] + [links[0]]
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = [x for x in links if x[0] != x[1]]
    assert found == _slow_components({n for x in linked for n in x}, linked)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
