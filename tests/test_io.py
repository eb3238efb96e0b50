from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import rows
from pitlane import schemas
from pitlane.operators import derive
from pitlane.plans import pipeline
from pitlane.sources import bronze, shared, tables


def test_one_day_is_replaced_and_others_stay(spark, tmp_path):
    root = str(tmp_path)
    assert bronze.bronze_export_json(rows.listings(spark, {}, {}), root, "market_listings", "2024-03-04") == 2
    assert bronze.bronze_export_json(rows.listings(spark, {}), root, "market_listings", "2024-03-05") == 1
    assert bronze.bronze_export_json(rows.listings(spark, {}, {}, {}), root, "market_listings", "2024-03-05") == 3
    assert bronze.bronze_read_json(spark, root, "market_listings").count() == 5
    day = bronze.bronze_read_json(spark, root, "market_listings", "2024-03-04")
    assert day.count() == 2 and day.first()["export_day"] == 4


def test_nested_documents_survive_json(spark, tmp_path):
    vehicles = [{"make": "Citroën", "model": "C4", "year_from": 2010, "year_to": 2012}]
    df = rows.parts(spark, {"vehicle_compatibility": vehicles, "price_eur": None})
    bronze.bronze_export_json(df, str(tmp_path), "parts_catalog", "2024-03-05")
    row = bronze.bronze_read_json(spark, str(tmp_path), "parts_catalog").first()
    assert row["vehicle_compatibility"][0].asDict() == vehicles[0] and row["price_eur"] is None
    text = bronze.bronze_nested_to_json(df).first()["vehicle_compatibility"]
    assert text == '[{"make":"Citroën","model":"C4","year_from":2010,"year_to":2012}]'


def test_export_is_compressed_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bronze, "EXPORT_ROWS", 300, raising=False)
    many = rows.parts(spark, *({"part_id": str(i)} for i in range(1000))).coalesce(1)
    assert bronze.bronze_export_json(many, str(tmp_path), "parts_catalog", "2024-03-05") == 1000
    files = list((tmp_path / "parts_catalog").rglob("part-*"))
    assert len(files) == 4 and all(f.suffix == ".gz" for f in files)
    back = bronze.bronze_read_json(spark, str(tmp_path), "parts_catalog")
    assert back.select("part_id").distinct().count() == 1000
    text = sum(len(r[0]) for r in spark.read.text(f"{tmp_path}/parts_catalog").select("value").collect())
    assert sum(f.stat().st_size for f in files) * 5 < text


def test_bad_run_date(spark):
    with pytest.raises(ValueError):
        bronze.bronze_date_stamp(rows.listings(spark, {}), "2024-02-30")


def test_empty_collection_is_skipped(spark, tmp_path):
    assert not bronze.bronze_write_parquet(rows.recalls(spark), str(tmp_path), "vehicle_recalls")
    assert bronze.bronze_write_parquet(rows.recalls(spark, {}), str(tmp_path), "vehicle_recalls")
    assert "_raw" not in spark.read.parquet(f"{tmp_path}/vehicle_recalls").columns


def test_silver_rewrite_leaves_no_old_month(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2), (3, None, None)], "k int, ingested_year int, ingested_month int")
    tables.silver_write_partitioned(df, path)
    assert spark.read.parquet(path).count() == 3
    tables.silver_write_partitioned(df.where("k = 2"), path)
    assert [r["k"] for r in spark.read.parquet(path).collect()] == [2]


def test_partition_filter_prunes(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.range(100).selectExpr("id", "2024 AS ingested_year", "cast(id % 12 + 1 AS int) AS ingested_month")
    tables.silver_write_partitioned(df, path)
    plan = tables.scan_parquet(spark, path).where("ingested_month = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingested_month" in plan


def test_missing_mart_is_empty(spark, tmp_path):
    assert tables.gold_read_mart(spark, str(tmp_path), "mart_market_pricing").isEmpty()


def test_mart_order(spark, tmp_path):
    df = spark.createDataFrame([("b", "x", None), ("a", "x", 5.0), ("c", "x", 9.0)], "supplier string, brand_type string, supplier_score double")
    tables.gold_materialize(df, str(tmp_path), "mart_supplier_performance")
    mart = tables.gold_read_mart(spark, str(tmp_path), "mart_supplier_performance")
    assert [r["supplier"] for r in mart.collect()] == ["c", "a", "b"]
    assert "updated_at" in mart.columns


def test_whole_pipeline(spark, tmp_path):
    root, silver, gold = (str(tmp_path / n) for n in ("bronze", "silver", "gold"))
    bronze.bronze_export_json(rows.parts(spark, {}, {"part_id": "p2"}), root, "parts_catalog", "2024-03-05")
    bronze.bronze_export_json(rows.listings(spark, {}), root, "market_listings", "2024-03-05")
    bronze.bronze_export_json(rows.recalls(spark, {}), root, "vehicle_recalls", "2024-03-05")
    counts = pipeline.silver_run(spark, root, silver, ["parts_catalog", "nonsense", "market_listings", "vehicle_recalls"])
    assert counts == {"parts_catalog": 1, "market_listings": 1, "vehicle_recalls": 1}
    pipeline.gold_run(spark, silver, gold, F.lit("2024-03-05 00:00:00").cast("timestamp"))
    assert {name: tables.gold_read_mart(spark, gold, name).count() for name in pipeline.GOLD} == dict.fromkeys(pipeline.GOLD, 1)
    pricing = tables.gold_read_mart(spark, gold, "mart_market_pricing")
    broken = pricing.withColumn("catalog_median_price", F.lit(-1.0)).drop("updated_at")
    tables.gold_materialize(shared.store(broken, "broken"), gold, "mart_market_pricing")
    with pytest.raises(ValueError, match="negative_median_price: 1"):
        pipeline.validate(spark, gold)


def test_missing_bronze_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        pipeline.silver_run(spark, str(tmp_path), str(tmp_path / "out"), ["parts_catalog"])


def test_store_uses_the_configured_folder(spark):
    df = shared.store(spark.range(5), "numbers")
    assert df.inputFiles()[0].startswith("file://" + spark.conf.get("spark.checkpoint.dir"))


def test_recall_defaults(spark):
    raw = spark.createDataFrame([
        ('{"NHTSACampaignNumber":"24V1","Conséquence":"feu","Consequence":"fire","PotentialNumberOfUnitsAffected":12}',),
        ('{"Consequence":"fire","Manufacturer":"R SA"}',), ("{}",), ("not json",), (None,),
    ], "_raw string").selectExpr("_raw", "'RENAULT' AS make", "'CLIO' AS model", "2020 AS model_year")
    out = derive.recall_normalize(raw, "2024-01-01T00:00:00").collect()
    assert [(r["recall_id"], r["manufacturer"], r["consequence"], r["potentially_affected"]) for r in out] == [
        ("24V1", "RENAULT", "feu", 12), ("", "R SA", "fire", 0), *[("", "RENAULT", "", 0)] * 3]


def test_complaint_defaults(spark):
    raw = spark.createDataFrame([('{"odiNumber":11,"crash":true,"numberOfInjuries":2}',), ("{}",)], "_raw string")
    raw = raw.selectExpr("_raw", "'A' AS make", "'B' AS model", "2020 AS model_year")
    out = derive.complaint_normalize(raw, "2024-01-01T00:00:00").collect()
    assert [(r["complaint_id"], r["crash"], r["fire"], r["injuries"], r["deaths"]) for r in out] == [
        ("11", True, False, 2, 0), ("", False, False, 0, 0)]


def test_compatibility_ranges(spark):
    fits = spark.createDataFrame(
        [("P1", "A", "x", 2012), ("P1", "A", "x", 2010), ("P1", "A", "x", 2010), ("P1", "A", "w", 2015), ("P2", "B", "y", 2000)],
        "part_number string, make string, model string, year int")
    out = rows.by(derive.parts_compatibility_build(fits), "part_number")
    assert [tuple(v) for v in out["P1"]["vehicle_compatibility"]] == [("A", "w", 2015, 2015), ("A", "x", 2010, 2012)]


def test_numbers_in_any_spelling(spark, tmp_path):
    lines = [
        '{"listing_id":"a","vehicle_year":2004,"asking_price_eur":12.5,"days_to_sell":3}',
        '{"listing_id":"b","vehicle_year":2004.0,"asking_price_eur":"12.5","days_to_sell":"3.0"}',
        '{"listing_id":"c","vehicle_year":"2004","asking_price_eur":1.25e1,"days_to_sell":" 3 "}',
        '{"listing_id":"d","vehicle_year":"new","asking_price_eur":"-","days_to_sell":null}',
        '{"listing_id":"e","vehicle_year":2004', "",
    ]
    (tmp_path / "market_listings").mkdir()
    (tmp_path / "market_listings" / "x.json").write_text("\n".join(lines))
    df = bronze.bronze_read_documents(spark, str(tmp_path), "market_listings")
    found = {r["listing_id"]: (r["vehicle_year"], r["asking_price_eur"], r["days_to_sell"]) for r in df.collect()}
    assert [found[i] for i in "abc"] == [(2004, 12.5, 3)] * 3 and found["d"] == (None, None, None)
    assert df.schema == schemas.BRONZE["market_listings"]
    told = bronze.bronze_read_lines(spark, str(tmp_path / "market_listings"), df.schema)
    assert told.where(f"{schemas.CORRUPT} is not null").count() == 1 and told.count() == 5


def test_nested_numbers_in_any_spelling(spark, tmp_path):
    (tmp_path / "parts_catalog").mkdir()
    (tmp_path / "parts_catalog" / "x.json").write_text(
        '{"part_id":"a","vehicle_compatibility":[{"make":"m","model":"n","year_from":"1999","year_to":2001.0}]}'
    )
    (row,) = bronze.bronze_read_documents(spark, str(tmp_path), "parts_catalog").collect()
    assert row["vehicle_compatibility"][0].asDict() == {"make": "m", "model": "n", "year_from": 1999, "year_to": 2001}
