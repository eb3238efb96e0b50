from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from conftest import SF_DIR
from pitlane.operators import silver, silver_local
from pitlane.operators.dedup import latest_by
from pitlane.plans.lake import Lake
from pitlane.schemas import PLACE
from pitlane.session import PARTITIONS, SHUFFLED_BYTES, SMALL_SHUFFLED, STORED_BYTES_EACH, split_size, stored_bytes
from pitlane.sources import bronze, starmap

CASES = {
    "market_listings": silver.silver_listings,
    "vehicle_recalls": silver.silver_recalls,
}


@contextmanager
def _without_broadcasts(spark):
    """As with large tables."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    own = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in own.items():
            spark.conf.set(name, value)


def _above_joins(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "SortMergeJoin" in plan
    return plan.partition("SortMergeJoin")[0]


@pytest.mark.parametrize("collection", CASES)
def test_placed_documents_are_deduplicated_where_they_are(spark, collection):
    """Shuffled for the join with their orders, documents are not shuffled and sorted again as wide rows."""
    with _without_broadcasts(spark):
        kept = CASES[collection](starmap.placed(spark, SF_DIR, collection))
        assert "Exchange" not in _above_joins(kept) and _above_joins(kept).count("Sort [") == 1
        anywhere = CASES[collection](starmap.RAW[collection](spark, SF_DIR))
        assert "Exchange" in _above_joins(anywhere)
        assert kept.columns == anywhere.columns
        assert kept.count() > 0 and kept.exceptAll(anywhere).count() == anywhere.exceptAll(kept).count() == 0


def test_quotes_of_one_part_meet_in_one_task(spark):
    with _without_broadcasts(spark):
        raw = starmap.raw_parts(spark, SF_DIR).select("_fingerprint", F.spark_partition_id().alias("task"))
        spread = raw.groupBy("_fingerprint").agg(F.countDistinct("task").alias("tasks"), F.count(F.lit(1)).alias("n"))
        most = spread.agg(F.max("tasks").alias("tasks"), F.max("n").alias("n")).first()
    assert most["n"] > 1 and most["tasks"] == 1


def test_place_is_no_key_and_leaves_with_the_deduplication(spark):
    rows = spark.createDataFrame(
        [("a", 1, 5, 0), ("a", 2, 5, 0), ("b", 1, None, 0), ("b", 3, None, 0), (None, 1, 7, 0), (None, 2, 7, 0)],
        f"id string, at int, {PLACE} long, tie int",
    )
    kept = latest_by(rows, ["id"], F.col("at"), [F.col("tie")])
    assert kept.columns == ["id", "at", "tie"]
    assert {(r["id"], r["at"]) for r in kept.collect()} == {("a", 2), ("b", 3), (None, 2)}


def test_tasks_of_medallion_jobs_read_small_shares_of_shuffles(spark):
    lines = f"{SF_DIR}/lineitem.parquet"
    assert stored_bytes(spark, lines) > 0 and stored_bytes(spark, f"{SF_DIR}/none.parquet") == 0
    own = spark.sparkContext.getConf().get(SHUFFLED_BYTES, "67108864b")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    queries = __spark_entry__.queries()
    try:
        queries["silver_parts"](spark, SF_DIR)
        assert spark.conf.get(SHUFFLED_BYTES) == SMALL_SHUFFLED and spark.conf.get(PARTITIONS, None) is None
        split_size(spark, widening=True, stored_bytes=(partitions + 1) * STORED_BYTES_EACH)
        assert int(spark.conf.get(PARTITIONS)) == partitions + 1
        split_size(spark, widening=True)
        assert spark.conf.get(PARTITIONS, None) is None
        split_size(spark, widening=False, stored_bytes=(partitions + 1) * STORED_BYTES_EACH)
        assert spark.conf.get(PARTITIONS, None) is None and spark.conf.get(SHUFFLED_BYTES) == own
    finally:
        split_size(spark, widening=True)


def test_placed_flat_listings_are_deduplicated_where_they_are(spark):
    lake = Lake(spark, SF_DIR)
    with _without_broadcasts(spark):
        kept = silver_local.silver_listings_local(lake.raw_flat("market_listings"))
        assert "Exchange" not in _above_joins(kept) and PLACE not in kept.columns
        flat = bronze.bronze_nested_to_json(bronze.bronze_drop_internal(lake.raw("market_listings")))
        anywhere = silver_local.silver_listings_local(flat)
        assert kept.columns == anywhere.columns
        assert kept.count() > 0 and kept.exceptAll(anywhere).count() == anywhere.exceptAll(kept).count() == 0
