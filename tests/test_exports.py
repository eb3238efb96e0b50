from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from pitlane import schemas as S
from pitlane.operators import silver
from pitlane.plans import pipeline, registry
from pitlane.plans.lake import Lake
from pitlane.sources import bronze, linked, shared, tables

LINES = [
    json.dumps({"part_id": "1", "part_number": "n", "price_eur": "12.5", "stock_quantity": 3.0, "_fingerprint": "f",
                "vehicle_compatibility": [{"make": "M", "year_from": "1999"}], "ingested_at": "1996-03-13T00:00:00"}),
    json.dumps({"part_id": "2", "part_number": "n", "price_eur": "dear", "vehicle_compatibility": "none", "_fingerprint": "g"}),
    json.dumps({"part_id": 3, "part_number": {"a": 1}, "quality_score": True, "unknown": [1, {"b": 2}]}),
    '{"part_id": "4", "part_number": "n", "vehicle_compatibility": [{"make": "M"',
    '{"part_id": "5", "part_number": "n", "vehicle_compatibility": [{"make": tru}], "brand": "b"}',
    '[{"part_id": "6", "part_number": "n"}, {"part_id": "7", "part_number": "n"}]',
    '{"part_id": "8", "part_id": "9", "part_number": "n"} {"part_id": "10"}',
    '"text"', "null", "{}", "   ", "\t", "",
]


@pytest.fixture
def exported(tmp_path):
    folder = tmp_path / "parts_catalog" / "year=2024" / "month=3" / "day=5"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text("\n".join(LINES) + "\n")
    return str(tmp_path)


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


@pytest.mark.parametrize("name", silver.CLEANERS)
def test_a_line_is_parsed_once(spark, tmp_path, name):
    """Conditions on fields went below the parser, each with a parser of its own."""
    folder = tmp_path / name / "year=2024" / "month=3" / "day=5"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text("{}\n")
    assert _plan(silver.CLEANERS[name](bronze.bronze_read_json(spark, str(tmp_path), name))).count("from_json(") == 1


def test_fields_read_alone_are_those_of_whole_documents(spark, exported):
    whole = bronze.bronze_read_json(spark, exported, "parts_catalog").select(*S.SILVER_PARTS)
    alone = bronze.bronze_read_json(spark, exported, "parts_catalog", columns=S.SILVER_PARTS).select(*S.SILVER_PARTS)
    assert alone.schema == whole.schema
    rows = sorted(map(str, whole.collect()))
    assert rows == sorted(map(str, alone.collect())) and len(rows) == 11
    assert {r["part_id"] for r in whole.collect()} >= {"1", "2", "3", "5", None}


def test_silver_run_leaves_its_tables_only(spark, exported, tmp_path):
    silver_root, before = str(tmp_path / "silver"), _shuffle_files(spark)
    written = pipeline.silver_run(spark, exported, silver_root, ["parts_catalog"])
    assert _shuffle_files(spark) <= before
    kept = silver.silver_parts(bronze.bronze_read_json(spark, exported, "parts_catalog"))
    assert written == {"parts_catalog": kept.count()} and written["parts_catalog"] > 0
    own = f"{shared.shared_dir(spark)}/{spark.sparkContext.applicationId}".removeprefix("file:")
    assert not [name for name in os.listdir(own) if name.startswith("cleaned_")]
    assert os.listdir(silver_root) == ["parts_catalog"]


WRITES = {
    "store": lambda df, path: shared.store(df, "numbers"),
    "commit": lambda df, path: linked.commit(df, path),
    "silver": lambda df, path: tables.silver_write_partitioned(df, path, ["k"]),
    "flat": lambda df, path: tables.silver_write_flat(df, path),
    "flat bronze": lambda df, path: bronze.bronze_write_parquet(df, path, "numbers"),
    "export": lambda df, path: bronze.bronze_export_json(df, path, "numbers", "2024-03-05"),
}


@pytest.mark.parametrize("write", WRITES)
def test_a_write_releases_its_shuffles(spark, tmp_path, write):
    """They stayed until the driver collected its garbage, so the steps of a job added theirs up."""
    own = spark.conf.get(shared._RELEASED, None)
    numbers = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("id").alias("n"))
    before = _shuffle_files(spark)
    WRITES[write](numbers, str(tmp_path / "out"))
    assert _shuffle_files(spark) <= before and spark.conf.get(shared._RELEASED, None) == own


@pytest.mark.parametrize("query", ["bronze_read_spellings", "bronze_read_documents"])
def test_landed_documents_are_compressed(spark, query):
    files = registry.QUERIES[query](Lake(spark, SF_DIR)).inputFiles()
    assert files and all(f.endswith(".gz") for f in files)
