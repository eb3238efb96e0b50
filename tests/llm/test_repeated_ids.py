"""Ids that are null or repeat in bulk, one id on several texts, labelled ids that are missing, clashing names."""

from __future__ import annotations

import random

import pytest
from conftest import SF_DIR

from pitlane.llm import common, decontaminate, neardup, secret_scan, sharding, zstd_models
from pitlane.llm.common import table


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))


@pytest.mark.parametrize("hot", ["one id", "one row", "no id"])
def test_shards_stay_even(spark, hot):
    rng = random.Random(1)
    texts = [prose(rng, 12) for _ in range(9000)]
    rows = [(i, t) for i, t in enumerate(texts)]
    for i in range(0, 9000, 3):
        rows[i] = {"one id": (7, texts[i]), "one row": (7, texts[7]), "no id": (None, texts[i])}[hot]
    found = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    loads, slots = [0] * 8, [[] for _ in range(8)]
    for r in found:
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert sum(loads) == sum(len(t) + 1 for _, t in rows)
    assert max(loads) < 1.02 * sum(loads) / 8 and min(loads) > 0.98 * sum(loads) / 8
    assert all(sorted(s) == list(range(len(s))) for s in slots)


def test_sample_of_secrets_is_bounded(spark, monkeypatch):
    drawn = {}
    monkeypatch.setattr(secret_scan, "SAMPLE_ROWS", 100)
    real = common.drawn
    monkeypatch.setattr(common, "drawn", lambda *a: drawn.setdefault("rows", real(*a)))
    rows = [(None if i % 3 else i, f"word{i} other") for i in range(6000)] + [(None, "same row")] * 3000
    secret_scan.samples(spark.createDataFrame(rows, "doc_id long, text string"))
    assert 40 < drawn["rows"].distinct().count() < 200


def test_labels_of_missing_documents(spark):
    """The texts learned from are those of labelled documents that are there."""
    documents, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    some = documents.filter("doc_id % 4 = 1").unionByName(documents.filter("doc_id % 4 = 1").selectExpr(
        "doc_id", "text || ' another' as text", "lang", "source", "n_chars"))
    (bad, good), _ = zstd_models.training_texts(some, labels, "quality", (1000, 1000))
    known = zstd_models.learning_rows(labels, "quality").join(some.select("doc_id").distinct(), "doc_id")
    assert len(bad) + len(good) == known.select("doc_id").distinct().count() > 10
    again, _ = zstd_models.training_texts(some.repartition(5), labels, "quality", (1000, 1000))
    assert again == (bad, good)
    limited, _ = zstd_models.training_texts(some, labels, "quality", (3, 4))
    assert len(limited[0]) <= 3 and len(limited[1]) <= 4


def test_characters_learned_from_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(zstd_models, "TRAINING_TOTAL", 20_000)
    documents, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    texts, _ = zstd_models.training_texts(documents, labels, "quality", (1000, 1000))
    assert all(sum(map(len, side)) <= 10_000 for side in texts) and any(texts)


def test_one_id_on_two_texts(spark):
    rng = random.Random(2)
    one, other = prose(rng, 60), prose(rng, 60)
    rows = [(5, one), (5, other), (3, one + " more"), (9, other)]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(3, 3), (5, 3), (5, 5), (9, 5)]


NAMES = ["_id", "_key", "_own_id", "_own_key", "_found_id", "_found_key", "component", "first", "key", "class", "label", "others"]


def test_clashing_names(spark):
    rng = random.Random(3)
    one, item = prose(rng, 60), prose(rng, 30)
    rows = [(1, one), (2, one), (3, f"{prose(rng, 20)} {item} {prose(rng, 20)}"), (4, prose(rng, 50))]
    documents = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *[f"doc_id as `{n}`" for n in NAMES])
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    for kept, ids in ((neardup.without_near_duplicates(documents), [1, 3, 4]),
                      (decontaminate.without_contaminated(documents, items), [1, 2, 4])):
        assert kept.columns == documents.columns
        assert sorted(tuple(r[n] for n in ["doc_id", *NAMES]) for r in kept.collect()) == [(i,) * (len(NAMES) + 1) for i in ids]
