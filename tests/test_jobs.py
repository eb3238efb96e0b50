from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import rows
from pitlane import jobs
from pitlane.plans import pipeline
from pitlane.sources import bronze, tables


@pytest.fixture
def folder(spark, tmp_path):
    def path(name: str) -> str:
        return str(tmp_path / name)

    rows.parts(spark, {}, {"part_id": "p2", "_fingerprint": "f2"}).write.json(path("landing/parts_catalog"))
    rows.listings(spark, {}, {"listing_id": "l2"}).write.json(path("landing/market_listings"))
    rows.recalls(spark, {}, {"recall_id": "r2", "make": "FIAT"}).write.json(path("landing/vehicle_recalls"))
    return path


def test_scheduled_steps(spark, folder):
    jobs.main(["export", "--source", folder("landing"), "--bronze", folder("bronze"), "--run-date", "2024-03-05"])
    jobs.main(["silver", "--bronze", folder("bronze"), "--silver", folder("silver")])
    jobs.main(["gold", "--silver", folder("silver"), "--gold", folder("gold")])
    pricing = tables.gold_read_mart(spark, folder("gold"), "mart_market_pricing").first()
    assert (pricing["nb_catalog_references"], pricing["nb_market_listings"]) == (2, 2)


def test_sources_over_all_quotes(spark, folder):
    quotes = rows.parts(spark, {"source": "a"}, {"part_id": "p2", "source": "b"}, {"part_id": "p3", "source": "c"})
    quotes.write.mode("overwrite").json(folder("landing/parts_catalog"))
    jobs.main(["export", "--source", folder("landing"), "--bronze", folder("bronze"), "--run-date", "2024-03-05"])
    jobs.main(["silver", "--bronze", folder("bronze"), "--silver", folder("silver")])
    found = []
    for extra in ([], ["--quotes-from", folder("bronze")]):
        jobs.main(["gold", "--silver", folder("silver"), "--gold", folder("gold"), *extra])
        found.append(tables.gold_read_mart(spark, folder("gold"), "int_parts_enriched").first()["nb_sources"])
    assert found == [1, 3]


def test_ingest_step(spark, folder):
    command = ["ingest", "--landing", folder("landing"), "--tables", folder("tables"), "--run-log", folder("runs"),
               "--collections", "parts_catalog", "vehicle_recalls", "--makes", "FIAT"]
    jobs.main(command)
    recalls = pipeline.merged_table(spark, folder("tables/vehicle_recalls"))
    assert [r["recall_id"] for r in recalls.collect()] == ["r2"]
    run = spark.read.parquet(folder("runs")).first()
    assert run["results"]["parts_catalog"]["inserted"] == 2 and run["total_docs"] == 3
    # A run that ended before its manifest was written has changed nothing.
    recalls.withColumn("_bucket", F.lit(1)).write.partitionBy("_bucket").parquet(
        folder("tables/vehicle_recalls/data/_version=000000002"))
    assert pipeline.merged_table(spark, folder("tables/vehicle_recalls")).count() == 1


def test_local_step(spark, folder):
    for name in ("parts_catalog", "market_listings"):
        bronze.bronze_write_parquet(bronze.bronze_read_documents(spark, folder("landing"), name), folder("flat"), name)
    jobs.main(["local", "--bronze", folder("flat"), "--silver", folder("silver"), "--gold", folder("gold")])
    for name in pipeline.LOCAL_GOLD:
        assert tables.gold_read_mart(spark, folder("gold"), name).count() == 1


def test_a_named_day_removes_no_other(spark, folder):
    for day, part in (("2024-03-04", "p1"), ("2024-03-05", "p2")):
        df = rows.parts(spark, {"part_id": part, "_fingerprint": part, "ingested_at": f"{day}T00:00:00"})
        bronze.bronze_export_json(df, folder("bronze"), "parts_catalog", day)
    command = ["silver", "--bronze", folder("bronze"), "--silver", folder("silver"), "--datasets", "parts_catalog"]
    for extra in ([], ["--run-date", "2024-03-04"]):
        jobs.main([*command, *extra])
        assert {r["part_id"] for r in spark.read.parquet(folder("silver/parts_catalog")).collect()} == {"p1", "p2"}


def test_silver_kept_up_day_by_day(spark, folder):
    for day, part in (("2024-03-04", "p1"), ("2024-03-05", "p2")):
        df = rows.parts(spark, {"part_id": part, "_fingerprint": part, "ingested_at": f"{day}T00:00:00"})
        bronze.bronze_export_json(df, folder("bronze"), "parts_catalog", day)
        jobs.main(["silver", "--bronze", folder("bronze"), "--silver", folder("silver"), "--datasets", "parts_catalog",
                   "--update-with", day])
    catalog = pipeline.staging_views(spark, folder("silver"))["stg_parts_catalog"]
    assert {r["part_id"] for r in catalog.collect()} == {"p1", "p2"}


@pytest.mark.parametrize("day", ["2024-W10-2", "20240305", "2024-03"])
def test_other_date_forms_are_refused(spark, folder, day):
    with pytest.raises(ValueError):
        bronze.bronze_export_json(rows.recalls(spark, {}), folder("bronze"), "vehicle_recalls", day)


@pytest.mark.parametrize("recalls", ["none", "empty", "some"])
def test_all_steps_after_each_other(spark, folder, recalls):
    """Ingest to gold: what ingest merged is what is exported, and gold takes what there is."""
    feeds = ["parts_catalog", "market_listings", *(["vehicle_recalls"] if recalls != "none" else [])]
    if recalls == "empty":
        rows.recalls(spark, {}).limit(0).write.mode("overwrite").json(folder("landing/vehicle_recalls"))
    for price in (10.0, 30.0):
        rows.parts(spark, {"price_eur": price, "ingested_at": f"2024-03-{int(price):02d}T00:00:00"}).write.mode(
            "overwrite").json(folder("landing/parts_catalog"))
        jobs.main(["ingest", "--landing", folder("landing"), "--tables", folder("tables"), "--run-log", folder("runs"),
                   "--collections", *feeds])
    jobs.main(["export", "--source", folder("tables"), "--format", "tables", "--bronze", folder("bronze"),
               "--collections", *feeds, "--run-date", "2024-03-05"])
    jobs.main(["silver", "--bronze", folder("bronze"), "--silver", folder("silver"), "--datasets", *feeds])
    for _ in range(2):
        jobs.main(["gold", "--silver", folder("silver"), "--gold", folder("gold")])
    assert [r["price_eur"] for r in spark.read.parquet(folder("silver/parts_catalog")).collect()] == [30.0]
    pricing = tables.gold_read_mart(spark, folder("gold"), "mart_market_pricing").collect()
    assert [r["catalog_median_price"] for r in pricing] == [30.0] and pricing[0]["nb_market_listings"] == 2
    impact = tables.gold_read_mart(spark, folder("gold"), "mart_recall_impact").count()
    assert (impact > 0) == (recalls == "some")
    assert sorted(p.name for p in Path(folder("gold")).iterdir()) == sorted([*pipeline.GOLD, "int_parts_enriched"])


def test_versions_count_up(spark, folder):
    """Each version is read while the next one is written; old ones go, incomplete ones are never used."""
    for n in range(6):
        spark.range(n + 1).write.mode("errorifexists")
        tables.write_next_version(spark.range(n + 1), folder("versions"))
    assert tables.latest_version(spark, folder("versions")).count() == 6
    assert len(list(Path(folder("versions")).iterdir())) == 3
    Path(folder("versions/version=000000007")).mkdir()
    Path(folder("versions/version=000000007/part")).touch()
    assert tables.write_next_version(spark.range(9), folder("versions")).endswith("8")
    assert tables.latest_version(spark, folder("versions")).count() == 9


def test_other_document_sources_pass_through(spark, folder, tmp_path):
    path = str(tmp_path / "orc")
    rows.recalls(spark, {}).write.orc(path)
    df = bronze.bronze_read_documents(spark, "ignored", "vehicle_recalls", "orc", path=path)
    assert df.agg(F.count("*")).first()[0] == 1
