"""Documents merged into a keyed table a few buckets at a time."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from pitlane.plans import pipeline
from pitlane.sources import linked, shared
from test_linked import documents, seen


def _loads(spark, root):
    """Outcomes of loads that bring new keys, newer and older documents, unusable keys and another type."""
    unusable = spark.createDataFrame([("", 9), (None, 9)], "id string, v int").withColumn("ingested_at", F.lit("2024-01-09").cast("timestamp"))
    loads = [
        documents(spark, range(40), 2), documents(spark, range(20, 60), 3).unionByName(unusable),
        documents(spark, [1, 1, 30, 70], 1), documents(spark, [5], 4).withColumn("v", F.lit(2.5)),
    ]
    told = [pipeline.merge_landed(df, root, "id", seen(i + 1), buckets=8) for i, df in enumerate(loads)]
    return told, sorted(map(tuple, pipeline.merged_table(spark, root).collect()))


def test_passes_give_what_one_gives(spark, tmp_path, monkeypatch):
    whole = _loads(spark, str(tmp_path / "whole"))
    assert whole[0] == [(40, 0, 0, 40), (20, 20, 0, 42), (1, 0, 0, 4), (0, 1, 0, 1)] and len(whole[1]) == 61
    committed, commit = [], linked.commit
    monkeypatch.setattr(linked, "commit", lambda df, *args: committed.append(len(df)) or commit(df, *args))
    monkeypatch.setattr(pipeline, "PASS_BYTES", 1, raising=False)
    assert _loads(spark, str(tmp_path / "passes")) == whole
    # One bucket at a time, and one version each time; the last load writes all buckets again.
    assert committed[:2] == [8, 8] and committed[3] == 8
    assert linked.manifest(spark, str(tmp_path / "passes")).number == 4


def test_landed_documents_go_when_they_are_merged(spark, tmp_path):
    own = f"{shared.shared_dir(spark)}/{spark.sparkContext.applicationId}".removeprefix("file:")
    pipeline.merge_landed(documents(spark, range(9), 1), str(tmp_path / "t"), "id", seen(1), buckets=8)
    assert not [name for name in os.listdir(own) if name.startswith("landed-")]
    with pytest.raises(Exception):
        pipeline.merge_landed(documents(spark, range(9), 1).drop("id"), str(tmp_path / "t"), "id", seen(1))
    assert not [name for name in os.listdir(own) if name.startswith("landed-")]
