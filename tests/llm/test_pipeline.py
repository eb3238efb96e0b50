"""The pipeline stage by stage against what each stage must do."""

from __future__ import annotations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from llm.test_near_duplicates import _expected
from llm.test_scans import _slow_base
from pitlane.llm import secret_scan
from pitlane.llm.common import table
from pitlane.llm.line_quality import line_quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, found = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        found.append({r.doc_id: r for r in docs.collect()})
    return found


def test_quality(spark, stages):
    kept = {r.doc_id for r in line_quality(table(spark, SF, "documents")).collect() if r.kept}
    assert set(stages[0]) == kept


def test_near_duplicates(stages):
    assert set(stages[1]) == set(_expected({i: r.text for i, r in stages[0].items()}).values())


def test_decontamination(spark, stages):
    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    assert set(stages[2]) == {i for i, r in stages[1].items() if not any(t in r.text for t in items)}


def test_secrets(stages):
    assert set(stages[3]) == set(stages[2])
    for i, r in stages[3].items():
        assert not _slow_base(r.text)
        if not secret_scan.base_spans(stages[2][i].text) and "[SECRET]" not in r.text:
            assert r.text == stages[2][i].text and r.n_chars == stages[2][i].n_chars


def test_tokens(stages):
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    assert set(stages[4]) == set(stages[3])
    for i, r in stages[4].items():
        assert r.ids == library.encode(stages[3][i].text, add_special_tokens=False).ids and r.n_tokens == len(r.ids)
