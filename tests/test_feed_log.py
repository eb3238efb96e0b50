"""The streamed log under any names of loads and with fields that come later; registration in the catalog."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pitlane import schemas as S
from pitlane.sources import tables
from pitlane.streaming import feed


def test_names_of_loads_and_later_fields(spark, tmp_path):
    log, snapshots = str(tmp_path / "log"), str(tmp_path / "snapshots")

    def append(load: str, specs, columns: str, present=None):
        df = spark.createDataFrame(specs, columns).withColumns({
            "ingested_at": F.lit(f"2024-01-{int(load.strip('t')):02d}").cast("timestamp"),
            "first_seen_at": F.lit("2024-02-01").cast("timestamp"), feed.LOAD: F.lit(load),
        })
        if present:
            df = df.withColumn(S.PRESENT, F.array(*map(F.lit, present)))
        df.write.mode("append").partitionBy(feed.LOAD).parquet(log)

    append("01", [("a", 1), ("b", 1)], "id string, v int")
    append("02", [("a", 2)], "id string, v int")
    feed.compact(spark, log, snapshots, "id")
    append("10", [("a", 3, "late")], "id string, v int, w string", ["id", "w", "ingested_at"])
    assert {r[0] for r in feed.read_log(spark, log).select(feed.LOAD).distinct().collect()} == {"01", "02", "10"}
    found = {r["id"]: (r["v"], r["w"]) for r in feed.current(spark, log, snapshots, "id").collect()}
    assert found == {"a": (2, "late"), "b": (1, None)}


def test_registration_takes_no_other_table_away(spark, tmp_path):
    folder = str(tmp_path / "it's here")
    spark.range(3).withColumn("p", F.lit(1)).write.partitionBy("p").parquet(folder)
    schema = spark.read.parquet(folder).schema
    for _ in range(2):
        assert tables.catalog_register(spark, "registered_twice", schema, ["p"], folder).count() == 3
    spark.range(1).createOrReplaceTempView("a_view_of_its_own")
    with pytest.raises(ValueError):
        tables.catalog_register(spark, "a_view_of_its_own", schema, ["p"], folder)
    spark.sql("drop table registered_twice")
