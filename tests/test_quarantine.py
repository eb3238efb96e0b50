"""What a table cannot hold, and that nothing is lost on the way."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from pitlane import schemas as S
from pitlane.plans import pipeline
from pitlane.sources import bronze

LINES = [
    '{"part_id":"a","price_eur":12.5,"ingested_at":"2024-01-01T00:00:00"}',
    '{"part_id":"b","price_eur":"cheap","stock_quantity":"many","ingested_at":"2024-01-01T00:00:00"}',
    '{"part_id":"c","vehicle_compatibility":[{"make":"m","year_from":"old","year_to":2001}],"ingested_at":"yesterday"}',
    '{"part_id":"","price_eur":"9"}', '{"price_eur":1}', 'no document', '{"part_id":"d"', '[1]',
    '{"part_id":"a","price_eur":13,"ingested_at":"2024-01-02T00:00:00"}',
]


def test_every_document_is_somewhere(spark, tmp_path):
    landing, root, aside = (str(tmp_path / n) for n in ("parts_catalog", "tables", "quarantine"))
    spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1).write.text(landing)
    for _ in range(2):  # repeated, it changes nothing
        landed = {"parts_catalog": bronze.bronze_read_lines(spark, landing, S.BRONZE["parts_catalog"], told=True)}
        pipeline.ingest_run(spark, landed, root, str(tmp_path / "runs"), datetime(2024, 2, 1), quarantine=aside)
    found = spark.read.parquet(aside).where(F.col("collection") == "parts_catalog")
    assert sorted((r.reason, r.field or "") for r in found.collect()) == [
        ("no document", "")] * 3 + [("no key", "part_id")] * 2 + [
        ("value", "ingested_at"), ("value", "price_eur"), ("value", "stock_quantity"), ("value", "vehicle_compatibility")]
    assert found.where("file is null").count() == 0
    texts = {(r.reason, r.field): r.content for r in found.collect()}
    assert texts["value", "price_eur"] == "cheap" and '"old"' in texts["value", "vehicle_compatibility"]
    table = {r.part_id: r for r in pipeline.merged_table(spark, f"{root}/parts_catalog").collect()}
    assert set(table) == {"a", "b", "c"} and table["a"].price_eur == 13.0 and table["b"].price_eur is None
    # Three keys, one superseded, three lines, two without key: all nine.
    whole = found.where("reason <> 'value'").count()
    assert len(table) + 1 + whole == len(LINES)
    assert not set(spark.read.parquet(str(tmp_path / "runs")).columns) & {"_file"}
