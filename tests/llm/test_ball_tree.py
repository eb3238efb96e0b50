"""Ball-tree search against exact scores of all documents."""

from __future__ import annotations

import random
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from pitlane.llm import ball_tree

WORDS = [f"w{i}" for i in range(300)]


def plainly(documents: list[tuple], items: list[tuple], k: int) -> list[tuple]:
    terms = [(i, Counter(t.decode() for t in ball_tree.terms_of(x))) for i, x in documents]
    n_docs, length = sum(bool(c) for _, c in terms), sum(c.total() for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in terms:
            m = 100 - 50 + 50 * c.total() * n_docs // length
            wanted = {t.decode() for t in ball_tree.terms_of(text)}
            score = sum(
                floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
                for t in wanted if t in c
            )
            if score > 0:
                scores.append((-score, i))
        out += [(item, n, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return out


@pytest.mark.parametrize(("tree", "leaf", "groups", "item_bytes"), [(4096, 32, 16_384, 1 << 18), (64, 4, 7, 200), (50, 3, 1, 1 << 18)])
def test_equals_exact_scores(spark, monkeypatch, tree, leaf, groups, item_bytes):
    for name, value in (("TREE", tree), ("LEAF", leaf), ("GROUPS", groups)):
        monkeypatch.setattr(ball_tree, name, value)
    rng = random.Random(tree)
    documents = [
        (i, " ".join(rng.choice(WORDS[: rng.choice([20, 300])]) for _ in range(rng.choice([1, 5, 40, 200])))) for i in range(700)
    ] + [(700 + i, "w1 w2, w3-W4") for i in range(90)] + [(900, ""), (901, None), (902, "Ünï w1")]
    items = [(i, " ".join(rng.sample(WORDS, rng.choice([1, 6, 30])))) for i in range(30)]
    items += [(90, "w1 w2 w3 w4"), (91, ""), (92, "ÜNÏ ünï"), (93, "w4 w4 W4")]
    found = ball_tree.ranked(
        spark.createDataFrame(documents, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"), 20, item_bytes,
    )
    assert sorted(tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()) == plainly(documents, items, 20)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 40, 2000)
    at = np.concatenate(([0], np.cumsum(sizes)))
    columns = np.concatenate([rng.choice(200, n, replace=False) + 200 * (i % 2) for i, n in enumerate(sizes)])
    values = rng.integers(1, 10**10, at[-1])
    dense = np.zeros((2000, 400), np.int64)
    dense[np.repeat(np.arange(2000), sizes), columns] = values
    for group in (np.zeros(400, int), np.arange(400) // 8, np.arange(400)):
        tree = ball_tree.Tree(at, columns, values, group)
        for terms in (np.arange(5), np.arange(390, 400), np.array([1, 250])):
            bounds = tree.bounds(terms)
            for (low, high, _), bound in zip(tree.nodes, bounds, strict=True):
                assert dense[tree.order[low:high]][:, terms].sum(1).max() <= bound
            visited = list(tree.best_first(terms, 1, 10))
            best = np.sort(np.concatenate([s for _, s in visited]))[-10:]
            assert best.tolist() == np.sort(dense[:, terms].sum(1))[-10:].tolist()
    assert sum(len(r) for r, _ in visited) < 1500
