"""Nulls, empty and long texts, repeated rows, clashing columns and empty tables, through every operator."""

from __future__ import annotations

import public_tokenizers
import pytest

import corpus_pipeline
from pitlane.llm import (
    ball_tree, bpe, decontaminate, license_scan, line_quality, neardup, secret_scan, sharding, simhash_grid, text_quality,
    token_alignment, token_counts, toxicity,
)

BYTES, LOWER = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PER_DOCUMENT = {
    "license": license_scan.licenses,
    "line_quality": line_quality.line_quality,
    "toxicity": lambda d: toxicity.toxicity(d, toxicity.Toxicity()),
    "sharding": sharding.sharded,
    "quality": lambda d: text_quality.quality(d, text_quality.Quality()),
    "secrets": secret_scan.scan,
    "counts": lambda d: token_counts.token_counts(d, BYTES),
    "near": neardup.near_duplicates,
    "bpe": lambda d: bpe.encode_and_decode(d, LOWER),
    "ids": lambda d: bpe.encoded(d, LOWER),
    "simhash": simhash_grid.near_duplicates,
    "alignment": lambda d: token_alignment.alignment(d, BYTES, PIECES),
}


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_per_document(odd_documents, no_documents, name):
    found = PER_DOCUMENT[name](odd_documents).collect()
    assert sorted(r.doc_id or 0 for r in found) == [0, 0, 1, 2, 3, 4, 5, 6, 7, 7, 8, 9]
    # Equal rows are spread over slots, so that one row in very many copies does not fill a shard.
    places = ("slot", "virtual_slot", "shard")
    twice = [tuple(v for k, v in r.asDict().items() if k not in places) for r in found if r.doc_id == 7]
    assert twice[0] == twice[1]
    assert PER_DOCUMENT[name](no_documents).collect() == []


def test_defined_results(odd_documents):
    by_id = lambda rows: {r.doc_id: r for r in rows.collect()}
    base = by_id(line_quality.line_quality(odd_documents))
    assert [base[i].n_words for i in (2, 3, 4, 6, 8)] == [0, 0, 0, 1, 3] and base[8].n_dup_lines == 1
    assert base[2].base_failed and not base[2].kept and base[5].n_words == 60_000
    counts = by_id(token_counts.token_counts(odd_documents, BYTES))
    assert [counts[i].n_tokens for i in (2, 3)] == [0, 0] and counts[2].n_bytes == 0
    near = by_id(neardup.near_duplicates(odd_documents))
    assert [near[i].component_id for i in (2, 3, 4, 7)] == [2, 3, 4, 7] and near[2].n_shingles == 0 and near[2].kept
    assert near[None].component_id is None and near[None].kept
    sizes = by_id(sharding.sharded(odd_documents))
    assert sizes[2].size == 1 and sizes[2].text_crc32 == 0
    assert by_id(secret_scan.scan(odd_documents))[9].n_assign == 1


def test_ranked(spark, odd_documents, no_documents):
    items = spark.createDataFrame(
        [(1, None), (None, ""), (2, "same text here"), (3, "zzz"), (None, "ABCDEF123"), (2, "same text here")],
        "item_id long, text string",
    )
    found = [tuple(r) for r in ball_tree.ranked(odd_documents, items).select("item_id", "rank", "doc_id").collect()]
    assert sorted(found, key=str) == [(2, 1, 7), (2, 2, 7), (None, 1, 9)]
    assert ball_tree.ranked(no_documents, items).count() == 0
    assert ball_tree.ranked(odd_documents, items.limit(0)).count() == 0


def test_contaminated(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, None), (None, ""), (2, "same text here for both of them"), (3, "no")],
                                  "item_id long, text string")
    found = decontaminate.contaminated(odd_documents, items).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(7, 2)]
    assert decontaminate.contaminated(no_documents, items).count() == 0
    assert decontaminate.contaminated(odd_documents, items.limit(0)).count() == 0
    kept = decontaminate.without_contaminated(odd_documents, items)
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count() - 2


@pytest.mark.parametrize("rows", ["odd_documents", "no_documents"])
def test_stages(spark, request, rows, tmp_path):
    docs = request.getfixturevalue(rows)
    columns = docs.columns
    spark.createDataFrame([(1, "some text of the benchmark that nobody has")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    for name, stage in corpus_pipeline.STAGES:
        assert docs.columns == columns
        docs = stage(spark, docs, str(tmp_path))
    assert docs.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    docs.collect()
