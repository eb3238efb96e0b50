"""Held-out accuracy of the two classifiers, and sharding against a plain count."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import duckdb

from conftest import SF_DIR
from pitlane.llm import queries, sharding, text_quality, toxicity

SF = "/root/testdata/sf0.1"


def _held_out(spark, found, label: str) -> tuple[float, float, float]:
    labels = dict(duckdb.sql(f"select doc_id, {label} from '{SF}/labels.parquet'").fetchall())
    rows = [r for r in found.collect() if r.held_out and r.doc_id in labels]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and 0 <= r.score <= 1 for r in rows)
    right = [r.predicted == labels[r.doc_id] for r in rows]
    ones = [r.predicted for r in rows if labels[r.doc_id]]
    zeros = [r.predicted for r in rows if not labels[r.doc_id]]
    return sum(right) / len(right), sum(ones) / len(ones), sum(zeros) / len(zeros)


def test_toxicity(spark):
    accuracy, caught, alarms = _held_out(spark, queries.op3_toxicity(spark, SF), "toxic")
    # With 352 toxic examples to learn from; about one in ten labelled texts here holds no toxic word at all.
    assert accuracy > 0.96 and caught > 0.7 and alarms < 0.01


def test_quality(spark):
    accuracy, kept, passed = _held_out(spark, queries.op5_text_quality(spark, SF), "quality")
    assert accuracy > 0.98 and kept > 0.99 and passed < 0.1
    assert text_quality.train(["x | y"] * 9, ["a good text"] * 9, 0.5).score(" \n") == 0.0


def test_one_kind_only():
    assert toxicity.train(["a good text"], [], 0.0).score("stupid") == 0.0
    assert toxicity.train([], ["x"] * 5, 1.0).score("anything") == 1.0
    assert text_quality.train(["x | y"] * 5, [], 0.0).score("any") == 0.0
    assert text_quality.train([], ["a good text"] * 5, 1.0).score("any") == 1.0


def test_shards(spark, tmp_path):
    texts = dict(duckdb.sql(f"select doc_id, text from '{SF_DIR}/documents.parquet'").fetchall())
    folder = str(tmp_path / "map")
    rows = sharding.sharded(spark.read.parquet(f"{SF_DIR}/documents.parquet"), 8, folder).collect()
    places, bytes_of = defaultdict(list), Counter()
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "bytes") and r.grown_shard is None
        places[r.shard].append(r.slot)
        bytes_of[r.shard] += r.size
    assert all(sorted(p) == list(range(len(p))) for p in places.values()) and set(places) == set(range(8))
    assert max(bytes_of.values()) - min(bytes_of.values()) <= 0.05 * sum(bytes_of.values()) / 8
    # Versions stay; the newest one counts; one more shard takes slots only into itself.
    old, new = (
        {r.virtual_slot: r.shard for r in sharding.stored_version(spark, folder, v).collect()} for v in (1, None)
    )
    assert len(old) == len(new) == sharding.SLOTS and old == {s: s % 8 for s in old}
    assert all(new[r.virtual_slot] == r.shard for r in rows)
    sharding.store_version(sharding.grown(sharding.stored_version(spark, folder), 8), folder)
    grown = {r.virtual_slot: r.shard for r in sharding.stored_version(spark, folder).collect()}
    assert all(grown[s] in (8, new[s]) for s in new) and 8 in grown.values()
    assert {r.virtual_slot: r.shard for r in sharding.stored_version(spark, folder, 2).collect()} == new


def test_hot_id_spreads_by_slot(spark):
    df = spark.range(5000).selectExpr("id as doc_id", "repeat('x', cast(id % 50 as int)) as text")
    load = Counter()
    for r in sharding.sharded(df, 8).collect():
        load[r.shard] += r.size
    assert max(load.values()) - min(load.values()) <= 100
